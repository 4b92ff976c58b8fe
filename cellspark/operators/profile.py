"""Table profiles: null counts, numeric summaries, non-zero shares, single-cell look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.functions.text import percent, quoted


# Names of the quartiles and their shares.
QUARTILES = {"quartile_1": 0.25, "median_value": 0.5, "quartile_3": 0.75}


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls of every column."""
    return df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(c) for c in df.columns])


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, non-null values and, for numbers, minimum, maximum, mean, deviation and quartiles.

    Quartiles are values of the column, off by at most a ten-thousandth of the rows, in bounded memory.

    All columns in one pass, as one row of aggregates that is then turned on its side.
    """
    stats = []
    for field in df.schema:
        is_number = isinstance(field.dataType, T.NumericType)
        number = (F.col(quoted(field.name)) if is_number else F.lit(None)).cast("double")
        stats.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("column_type"),
                F.count("*").alias("total_rows"),
                F.count(quoted(field.name)).alias("non_null"),
                F.min(number).alias("min_value"),
                F.max(number).alias("max_value"),
                F.round(F.avg(number), 2).alias("mean_value"),
                F.round(F.stddev_samp(number), 2).alias("std_value"),
                *[F.percentile_approx(number, share, 10_000).alias(name) for name, share in QUARTILES.items()],
            )
        )
    return df.agg(F.array(*stats).alias("columns")).select(F.inline("columns"))


def nonzero_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Non-zero count and percentage per column, as rows."""
    total = F.count("*")
    stats = []
    for name in columns:
        hits = F.count_if(F.col(name) != 0)
        stats.append(
            F.struct(F.lit(name).alias("column_name"), hits.alias("nonzero"), percent(hits, total).alias("nonzero_pct"))
        )
    return df.agg(F.array(*stats).alias("columns")).select(F.inline("columns"))


def nonzero_genes(cells: DataFrame, cell: list[str], expression: str = "expression") -> DataFrame:
    """Genes, non-zero genes and their share, per cell of a dense array table."""
    hits = F.size(F.filter(expression, lambda v: v != 0))
    return cells.select(
        *cell,
        F.size(expression).alias("genes"),
        hits.alias("nonzero"),
        percent(hits, F.size(expression)).alias("nonzero_pct"),
    )


def top_genes_of_cell(
    expr: DataFrame, cell: str, wanted: object, n: int = 3, alternative: str | None = None
) -> DataFrame:
    """Highest genes and values of one cell, found by its id or, failing that, by another id column."""
    chosen = expr.filter(F.col(cell) == F.lit(wanted))
    if alternative is not None and chosen.isEmpty():
        chosen = expr.filter(F.col(alternative) == F.lit(wanted))
    ordered = chosen.orderBy(F.col("value").desc(), F.col("gene_idx").desc())
    return ordered.limit(n).select(cell, "gene_idx", "symbol", "value")
