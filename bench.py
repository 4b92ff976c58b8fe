"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from cellspark.session import build_session
from workload import QUERIES

HEADLINE = (
    "c1_cell_sentence_topn",
    "c1_cell_sentence_variants",
    "c1_cell_sentence_sparse",
    "c1_cell_sentence_zero_filled",
    "c1_cell_sentence_dense",
    "c2_build_dataset",
    "c2_build_from_one_table",
    "c3_convert_dataset",
    "c4_resplit_dataset",
    "c5_extract_metadata",
    "c6_species_summary",
    "sp3_donor_random_split",
    "sp5_donor_quota_split_cells",
    "a11_dataset_summary",
    "j1_gene_symbol_mapping",
    "j3_publication_join",
    "x3_species_ages",
    "k4_all_datasets_split",
    "st1_incremental_ingest",
)
REPEATS = 2


def best_time(run) -> float:
    """Best of some runs; the rows are all computed and thrown away."""
    times = []
    for _ in range(REPEATS):
        started = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - started)
    return min(times)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["a1_row_counts"](spark, folder).collect()  # start-up is not measured
    seconds = {name: round(best_time(lambda name=name: QUERIES[name](spark, folder)), 3) for name in names}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
