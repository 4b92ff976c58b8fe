"""Cell sentences: the gene symbols of a cell in descending expression order.

Order everywhere: NaN first, then value descending, ties by gene index descending. Symbols that
look like Ensembl ids are left out. Two input forms give the same sentences, by the same route:

* long form ``(cell keys..., gene_idx, value)``, one row per cell and gene; one shuffle of the numbers
  by cell gives the array form;
* array form, one row per cell with ``indices``/``values`` (sparse) or ``expression`` (dense).
  While the gene tables can be broadcast, it needs no shuffle of the expression data.

Where one dataset has so many genes that a cell would meet a packed row far longer than its own values, the values
meet their genes one by one instead, in a shuffled join by gene, and are gathered by cell again.

A null or zero, stored or not, is a zero: it ranks among the zeros where genes without a value count
(``include_zeros``) and is left out where only values count. Genes may be numbered with gaps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspark.functions.text import has_ensembl_token, is_ensembl_id, quoted
from cellspark.operators.genes import flag_column, flagged_genes, gene_panel, ready_text
from cellspark.operators.joins import lookup_join, spread_join
from cellspark.session import materialize

SEPARATOR = " "
# Counted size of packed genes that may be broadcast.
BROADCAST_BYTES = 256 * 1024 * 1024
# Counted size of the packed genes of one dataset that every one of its cells may meet.
PANEL_BYTES = 4 * 1024 * 1024
# Fixed part of a gene in a packed row, beside the bytes of its symbol: places of the symbol and of list bits, usable position.
GENE_BYTES = 28


def sentence_columns(top_n: int | None, list_names: tuple[str, ...] | list[str], include_all: bool = True) -> list[str]:
    names = ["gene_sentence_all"] if include_all else []
    if top_n is not None:
        names.append(f"gene_sentence_{top_n}")
    return names + [f"gene_sentence_{name}" for name in list_names]


def attach_symbols(expr: DataFrame, genes: DataFrame, keys: list[str]) -> DataFrame:
    """Expression rows with the symbol of their gene, by gene index."""
    return lookup_join(expr, genes, keys, how="inner")


def rank_genes(expr: DataFrame, cell: list[str], top_n: int | None = None) -> DataFrame:
    """Add ``rank`` per cell over usable genes; with ``top_n`` only ranks up to it are kept.

    Ensembl-like genes rank behind all usable ones. With a limit Spark cuts each map task's share
    of a cell to ``top_n`` rows before the shuffle, so a very large cell does not move as a whole.
    """
    value = F.coalesce(F.col("value").cast("double"), F.lit(0.0))
    order = Window.partitionBy(*cell).orderBy(
        is_ensembl_id(F.col("symbol")).asc(), value.desc(), F.col("gene_idx").desc()
    )
    ranked = expr.withColumn("rank", F.row_number().over(order))
    return ranked if top_n is None else ranked.filter(F.col("rank") <= top_n)


def top_sentences(expr: DataFrame, cell: list[str], top_n: int) -> DataFrame:
    """``gene_sentence_<top_n>`` alone, from long form with symbols; cells without usable genes get ``''``."""
    usable = F.when(~is_ensembl_id(F.col("symbol")), F.struct("rank", "symbol"))
    words = F.sort_array(F.collect_list(usable))["symbol"]
    return rank_genes(expr, cell, max(top_n, 1)).groupBy(*cell).agg(
        F.array_join(F.slice(words, 1, top_n), SEPARATOR).alias(f"gene_sentence_{top_n}")
    )


def sentences_from_long(
    expr: DataFrame,
    genes: DataFrame,
    cell: list[str],
    top_n: int | None = 2000,
    list_names: tuple[str, ...] | list[str] = (),
    include_all: bool = True,
) -> DataFrame:
    """All sentence variants of the cells of a long table, from its values only.

    ``expr`` holds (dataset_id, cell keys..., gene_idx, value). The numbers are shuffled once, by cell;
    symbols and list membership come from the packed genes afterwards.
    """
    cells = to_sparse(expr, list(dict.fromkeys(["dataset_id", *cell])))
    return sentences_from_arrays(cells, genes, cell, top_n, list_names, include_all, include_zeros=False)


def to_sparse(expr: DataFrame, cell: list[str]) -> DataFrame:
    """Long form -> one row per cell with ``indices`` and ``values``, in gene order."""
    position = F.col("gene_idx").cast("int").alias("indices")
    value = F.col("value").cast("double").alias("values")
    pairs = F.sort_array(F.collect_list(F.struct(position, value)))
    grouped = expr.groupBy(*cell).agg(pairs.alias("_pairs"))
    return grouped.select(*cell, "_pairs.indices", "_pairs.values")


def to_long(cells: DataFrame, cell: list[str]) -> DataFrame:
    """Array form -> long form, stored entries only."""
    pairs = cells.select(*cell, F.explode(F.arrays_zip("indices", "values")).alias("_pair"))
    return pairs.select(*cell, F.col("_pair.indices").alias("gene_idx"), F.col("_pair.values").alias("value"))


def densify(cells: DataFrame, n_genes: str) -> DataFrame:
    """Sparse row -> ``expression`` array of ``n_genes`` values.

    Every stored value is followed by the zeros up to the next one, so only stored values are
    handled one by one.
    """
    pairs = F.arrays_zip(F.col("indices").alias("at"), F.col("values").alias("value"))
    ordered = cells.withColumn("_stored", F.sort_array(pairs))
    end = F.col(n_genes).cast("int")
    zero = F.lit(0.0)
    following = F.concat(F.slice("_stored.at", 2, F.greatest(F.size("_stored"), F.lit(1))), F.array(end))
    entries = F.arrays_zip(
        F.col("_stored.at").alias("at"),
        F.col("_stored.value").alias("value"),
        F.slice(following, 1, F.size("_stored")).alias("until"),
    )
    runs = F.transform(
        entries,
        lambda e: F.concat(F.array(F.coalesce(e["value"], zero)), F.array_repeat(zero, e["until"] - e["at"] - 1)),
    )
    before = F.array_repeat(zero, F.coalesce(F.get("_stored.at", F.lit(0)), end))
    return ordered.withColumn("expression", F.concat(before, F.flatten(runs))).drop("_stored")


def _positions(entries: Column) -> Column:
    """Gene positions of ``(value, position)`` entries, highest value first, ties by position descending."""
    return F.sort_array(entries, asc=False)["position"]


def stored_order(cells: DataFrame, sides: bool = True) -> DataFrame:
    """Replace the values of each cell by gene positions in order: ``_above`` and ``_below`` zero, or both as ``_order``.

    Zeros, stored or not, are left out and need no sorting; a cell without any array has none but
    zeros. Works on narrow rows, before any symbol.
    """
    if "expression" in cells.columns:
        every = F.when(F.size("expression") > 0, F.sequence(F.lit(0), F.size("expression") - 1))
        entries = F.arrays_zip(F.col("expression").alias("value"), every.alias("position"))
    else:
        entries = F.arrays_zip(F.col("values").alias("value"), F.col("indices").alias("position"))
    kept = [quoted(c) for c in cells.columns if c not in ("indices", "values", "expression")]
    stored = F.filter(entries, lambda e: e["value"] != 0)
    nothing = F.array().cast("array<int>")
    if not sides:
        return cells.select(*kept, F.coalesce(_positions(stored), nothing).alias("_order"))
    above = F.coalesce(_positions(F.filter("_stored", lambda e: e["value"] > 0)), nothing)
    below = F.coalesce(_positions(F.filter("_stored", lambda e: e["value"] < 0)), nothing)
    return cells.select(*kept, stored.alias("_stored")).select(*kept, above.alias("_above"), below.alias("_below"))


def _packed_bytes(genes: DataFrame, ready: list[str] | None = None) -> tuple[int, int]:
    """Counted size of the packed genes of all datasets, and of the longest, with the empty places between gene numbers.

    ``ready`` are the lists with a ready-made text beside that of all genes.
    """
    n, last = F.count("*"), F.max("gene_idx")
    word = F.octet_length("symbol") + 1
    texts = [] if ready is None else [word, *[F.when(F.col(quoted(f"in_{name}")), word).otherwise(0) for name in ready]]
    size = sum(texts, F.octet_length("symbol") + GENE_BYTES)
    per_dataset = genes.groupBy("dataset_id").agg(
        (F.sum(size) + 8 * (1 + len(texts)) * (last + 1)).alias("bytes"),
        ((F.min("gene_idx") < 0) | (F.count_distinct("gene_idx") != n)).alias("wrong"),
    )
    found = per_dataset.agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("most"), F.max("wrong").alias("wrong")).first()
    if found["wrong"]:
        raise ValueError("gene_idx must number the genes of every dataset from 0 on, each once")
    return found["bytes"] or 0, found["most"] or 0


def _with_words(ordered: DataFrame, genes: DataFrame, list_names: list[str]) -> DataFrame:
    """``_order`` replaced by ``_words``, the usable genes among them with symbol and list bits, by a join per gene.

    Every row is numbered where it is stored, so it stays by itself. A gene that most cells have is a skewed key of an
    inner join, which the planner splits.
    """
    rows = materialize(ordered.sparkSession, ordered.withColumn("_row", F.monotonically_increasing_id()), "ordered-cells")
    entries = rows.select("_row", "dataset_id", F.posexplode("_order").alias("_rank", "position"))
    met = entries.join(flagged_genes(genes, list_names), ["dataset_id", "position"]).drop("dataset_id", "position")
    word = F.struct("_rank", *[c for c in met.columns if c not in ("_row", "_rank")])
    words = met.groupBy("_row").agg(F.sort_array(F.collect_list(word)).alias("_words"))
    return rows.drop("_order").join(words, "_row", "left").drop("_row")


def sentences_from_arrays(
    cells: DataFrame,
    genes: DataFrame,
    cell: list[str],
    top_n: int | None = 2000,
    list_names: tuple[str, ...] | list[str] = (),
    include_all: bool = True,
    include_zeros: bool = True,
    cluster_by: list[str] | None = None,
) -> DataFrame:
    """All sentence variants from array form; other cell columns are kept, every row by itself.

    ``genes`` holds (dataset_id, gene_idx, symbol, in_<list>...). They are packed into one row per
    dataset, so that a cell finds its symbols by position; the packed rows are broadcast while the
    counted size of the genes allows it. All lists share small numbers with one bit each. Genes without a value follow the positive ones in descending
    position: the packed row holds the text of all genes, and of each list, ready-made, and the words of genes that a cell
    has a value for are cut out of it, so genes are looked up one by one only where a cell has a value. A packed
    row is as long as the largest gene number of its dataset; numbers without a gene are empty places.

    Where only values count and a dataset's packed row is longer than PANEL_BYTES, or all of them cannot be broadcast,
    values meet genes one by one. ``cluster_by`` brings rows of equal columns together before there are sentences.
    """
    kept = [quoted(c) for c in cells.columns if c not in ("indices", "values", "expression")]
    genes = materialize(cells.sparkSession, genes, "genes")
    size, longest = _packed_bytes(genes, list(list_names) if include_zeros else None)
    by_gene = not include_zeros and (longest > PANEL_BYTES or size > BROADCAST_BYTES)

    def clustered(rows: DataFrame) -> DataFrame:
        return rows.hint("rebalance", *cluster_by) if cluster_by else rows

    ordered = stored_order(cells if by_gene else clustered(cells), sides=include_zeros)
    names = sentence_columns(top_n, list_names, include_all)
    if by_gene:
        joined = clustered(_with_words(ordered, genes, list(list_names)))

        def of_words(i: int) -> Column:
            flags, bit = flag_column(i)
            return F.filter("_words", lambda w: w[flags].bitwiseAND(F.lit(bit)) != 0)["symbol"]

        every = F.col("_words.symbol")
        found = ([every] if include_all else []) + ([] if top_n is None else [F.slice(every, 1, top_n)])
        found += [of_words(i) for i in range(len(list_names))]
        columns = [F.array_join(w, SEPARATOR).alias(n) for w, n in zip(found, names, strict=True)]
        return joined.select(*kept, *columns).select(*kept, *[_or_empty(name) for name in names])
    panels = gene_panel(genes, list(list_names), include_zeros)
    joined = spread_join(ordered, panels, "dataset_id", cell, size, BROADCAST_BYTES)

    def words(positions: str | Column) -> Column:
        return F.transform(positions, lambda p: F.get(F.col("symbols"), p))

    def usable(positions: str) -> Column:
        return F.filter(positions, lambda p: F.get(F.col("symbols"), p).isNotNull())

    def of_list(positions: str, i: int) -> Column:
        flags, bit = flag_column(i)
        return F.filter(positions, lambda p: F.get(F.col(flags), p).bitwiseAND(F.lit(bit)) != 0)

    if include_zeros:
        # The first genes without a value are among as many first genes and the cell's own.
        valued = F.size("_above") + F.size("_below") + F.lit(top_n or 0)
        zeros = F.array_except(F.slice("usable", F.lit(1), valued), F.concat("_above", "_below"))
        staged = [F.slice(F.concat(usable("_above"), F.slice(zeros, 1, top_n or 0), usable("_below")), 1, top_n or 0).alias("_top"), "symbols"]
        parts = ["", *[f"_{i}" for i in range(len(list_names))]]
        for i, part in enumerate(parts, -1):
            cuts = F.transform(F.concat("_above", "_below"), lambda p: F.get(F.col(f"_cuts{part}"), p))
            staged += [F.sort_array(F.array_distinct(F.array_compact(cuts))).alias(f"_cut{part}"), f"_pieces{part}"]
            staged += [words(usable(side) if i < 0 else of_list(side, i)).alias(f"_words{side}{part}") for side in ("_above", "_below")]
        # Each in a step of its own, as what is used twice would be worked out twice.
        joined = joined.select(*kept, *staged)
        texts = [ready_text(part, f"_cut{part}").alias(f"_text{part}") for part in parts]
        joined = joined.select(*kept, F.array_join(words("_top"), SEPARATOR).alias("_top"), *texts, *[f"_words{side}{part}" for side in ("_above", "_below") for part in parts])

        def filled(part: str) -> Column:
            """Genes above zero, all others, those below zero."""
            text, sides = F.col(f"_text{part}"), [F.col(f"_words{side}{part}") for side in ("_above", "_below")]
            above, below = (F.when(F.size(side) > 0, F.array_join(side, SEPARATOR)) for side in sides)
            return F.array_join(F.array(above, F.when(text != "", F.left(text, F.length(text) - 1)), below), SEPARATOR)

        every, top, listed = filled(""), F.col("_top"), [filled(part) for part in parts[1:]]
    else:
        # array_join leaves out nulls, the words of genes that do not count.
        top = F.array_join(F.slice(words(usable("_order")), 1, top_n or 0), SEPARATOR)
        every = F.array_join(words("_order"), SEPARATOR)
        listed = [F.array_join(words(of_list("_order", i)), SEPARATOR) for i in range(len(list_names))]

    found = ([every] if include_all else []) + ([] if top_n is None else [top]) + listed
    columns = [text.alias(name) for text, name in zip(found, names, strict=True)]
    return joined.select(*kept, *columns).select(*kept, *[_or_empty(name) for name in names])


def _or_empty(name: str) -> Column:
    """Cells of a dataset without genes have no words."""
    return F.coalesce(quoted(name), F.lit("")).alias(name)


def sentence_quality(sentences: DataFrame, column: str) -> DataFrame:
    """Counts of sentences that are empty or still hold an Ensembl-like token."""
    return sentences.agg(
        F.count("*").alias("sentences"),
        F.count_if(F.length(column) == 0).alias("empty"),
        F.count_if(has_ensembl_token(F.col(column))).alias("with_ensembl_token"),
        F.max(F.length(column)).alias("longest"),
    )
