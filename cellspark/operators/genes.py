"""Gene identifiers: symbol mapping, mapping statistics, gene lists, per-dataset gene panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspark.functions.text import is_ensembl_id, percent, quoted
from cellspark.operators.columns import keep_first
from cellspark.operators.joins import lookup_join

# Column names of older symbol tables -> names used here.
SYMBOL_TABLE_RENAMES = {"Ensembl gene ID": "ensembl_gene_id", "Approved symbol": "symbol"}

# Gene lists that share one small number per gene.
LISTS_PER_FLAG = 15


def usable_symbols(symbols: DataFrame, order: list[str]) -> DataFrame:
    """``(ensembl_gene_id, symbol)`` with both present, first symbol per id in table order."""
    named = symbols.withColumnsRenamed({k: v for k, v in SYMBOL_TABLE_RENAMES.items() if k in symbols.columns})
    complete = named.filter(F.col("ensembl_gene_id").isNotNull() & F.col("symbol").isNotNull())
    return keep_first(complete, ["ensembl_gene_id"], order).select("ensembl_gene_id", "symbol")


def map_genes(var: DataFrame, symbols: DataFrame, order: list[str]) -> DataFrame:
    """Add ``symbol`` and ``mapped_via`` to every gene: symbol table, else feature name, else the id."""
    joined = lookup_join(var, usable_symbols(symbols, order), ["ensembl_gene_id"])
    feature = F.col("feature_name") if "feature_name" in var.columns else F.lit(None).cast("string")
    named_feature = F.when(~is_ensembl_id(feature), feature)
    via = (
        F.when(F.col("symbol").isNotNull(), "hgnc").when(named_feature.isNotNull(), "feature_name").otherwise("gene_id")
    )
    return joined.withColumns(
        {"mapped_via": via, "symbol": F.coalesce("symbol", named_feature, "ensembl_gene_id")}
    ).select(*var.columns, "symbol", "mapped_via")


def symbol_share(name: Column) -> Column:
    """Aggregate: are under half of the names Ensembl-like? False for no genes."""
    return F.coalesce(F.avg(is_ensembl_id(F.coalesce(name, F.lit("nan"))).cast("int")) < 0.5, F.lit(False))


def _feature_name(var: DataFrame) -> Column:
    return F.col("feature_name") if "feature_name" in var.columns else F.lit(None).cast("string")


def symbol_checks(var: DataFrame) -> DataFrame:
    """Per dataset: do gene ids and feature names, all of them, look like symbols? Without feature names they do not."""
    named = F.count(_feature_name(var)) > 0
    return var.groupBy("dataset_id").agg(
        symbol_share(F.col("ensembl_gene_id")).alias("var_names_are_symbols"),
        (named & symbol_share(_feature_name(var))).alias("feature_names_are_symbols"),
    )


def map_genes_without_table(var: DataFrame) -> DataFrame:
    """Symbols without a symbol table: feature names where they look like symbols, else (and where missing) the ids."""
    chosen = lookup_join(var, symbol_checks(var), ["dataset_id"])
    feature = F.when(F.col("feature_names_are_symbols"), _feature_name(var))
    return chosen.select(*var.columns, F.coalesce(feature, F.col("ensembl_gene_id")).alias("symbol"))


def mapping_stats(mapped: DataFrame) -> DataFrame:
    """Counts and percentages of genes by the way they got their symbol."""
    total = F.count("*")
    counts = {
        "hgnc": F.count_if(F.col("mapped_via") == "hgnc"),
        "fallback": F.count_if(F.col("mapped_via") == "feature_name"),
        "unmapped": F.count_if(F.col("mapped_via") == "gene_id"),
    }
    return mapped.agg(
        total.alias("total_genes"),
        counts["hgnc"].alias("mapped_via_hgnc"),
        counts["fallback"].alias("mapped_via_fallback"),
        counts["unmapped"].alias("unmapped_using_ensembl_id"),
        percent(counts["hgnc"], total).alias("hgnc_mapping_percentage"),
        percent(counts["fallback"], total).alias("fallback_percentage"),
        percent(counts["unmapped"], total).alias("unmapped_percentage"),
    )


def without_ensembl(genes: DataFrame, symbol: str = "symbol") -> DataFrame:
    return genes.filter(~is_ensembl_id(F.col(symbol)))


def gene_list_sizes(gene_lists: DataFrame) -> DataFrame:
    return gene_lists.distinct().groupBy("list_name").agg(F.count("*").alias("genes"))


def flag_lists(genes: DataFrame, gene_lists: DataFrame | None, names: list[str]) -> DataFrame:
    """Add a boolean column ``in_<list>`` per gene list, so that cells never look lists up by name."""
    if not names:
        return genes
    flags = [F.max(F.col("list_name") == name).alias(f"in_{name}") for name in names]
    members = gene_lists.filter(F.col("list_name").isin(names)).groupBy("symbol").agg(*flags)
    flagged = lookup_join(genes, members, ["symbol"])
    return flagged.withColumns({f"in_{n}": F.coalesce(quoted(f"in_{n}"), F.lit(False)) for n in names})


def flag_column(i: int) -> tuple[str, int]:
    """Column and bit of the ``i``-th gene list in a packed row."""
    return f"flags_{i // LISTS_PER_FLAG}", 1 << i % LISTS_PER_FLAG


def flagged_genes(genes: DataFrame, list_names: list[str]) -> DataFrame:
    """``dataset_id, position, symbol, flags_0, ...`` of the genes that count: one row per gene, all lists as bits."""
    flags: dict[str, Column] = {}
    for i, name in enumerate(list_names):
        column, bit = flag_column(i)
        own = F.when(F.col(quoted(f"in_{name}")), bit).otherwise(0)
        flags[column] = own if column not in flags else flags[column] + own
    usable = genes.where(~is_ensembl_id(F.col("symbol")))
    position = F.col("gene_idx").cast("int").alias("position")
    return usable.select("dataset_id", position, "symbol", *[c.cast("short").alias(n) for n, c in flags.items()])


# Words of one piece of a ready-made text.
PIECE_WORDS = 64
# Bits of a cut: the piece (above), where the word starts in it, how long it is with its blank.
START_BITS, LENGTH_BITS = 22, 20


def _with_cuts(genes: DataFrame, members: dict[str, Column]) -> DataFrame:
    """Add ``_cuts<part>``, the place of a gene's word in the ready-made text of a part, and ``_starts<part>``, where a piece
    of that text starts, at the piece's first word; null elsewhere. Words stand by descending gene number, each with a blank.
    """
    down = Window.partitionBy("dataset_id").orderBy(F.col("gene_idx").desc()).rowsBetween(Window.unboundedPreceding, 0)
    length = (F.length("symbol") + 1).cast("long")
    genes = genes.withColumns({f"_member{part}": F.coalesce(member, F.lit(False)) for part, member in members.items()})
    sums = {}
    for part in members:
        member = F.col(f"_member{part}")
        sums[f"_rank{part}"] = F.sum(member.cast("long")).over(down) - 1
        sums[f"_end{part}"] = F.sum(F.when(member, length)).over(down)
    genes = genes.withColumns(sums)
    genes = genes.withColumns(
        {f"_starts{part}": F.when(F.col(f"_member{part}") & (F.col(f"_rank{part}") % PIECE_WORDS == 0), F.col(f"_end{part}") - length) for part in members}
    )
    cuts = {}
    for part in members:
        start = F.col(f"_end{part}") - length - F.max(f"_starts{part}").over(down)
        fits = (start < 1 << START_BITS) & (length < 1 << LENGTH_BITS)
        piece = F.floor(F.col(f"_rank{part}") / PIECE_WORDS)
        cut = F.shiftleft(piece, START_BITS + LENGTH_BITS) + F.shiftleft(start, LENGTH_BITS) + length
        cuts[f"_cuts{part}"] = F.when(F.col(f"_member{part}"), F.when(fits, cut).otherwise(F.raise_error(F.lit("gene symbols of a million characters"))))
    return genes.withColumns(cuts)


def ready_text(part: str, cuts: str) -> Column:
    """The ready-made text of a part without the words at these cuts, which are sorted and distinct; a blank at its end."""
    pieces = F.col(f"_pieces{part}")
    whole, start_mask, length_mask = START_BITS + LENGTH_BITS, (1 << START_BITS) - 1, (1 << LENGTH_BITS) - 1
    end = F.shiftleft(F.size(pieces).cast("long"), whole)

    def start(cut: Column) -> Column:
        return F.shiftright(cut, LENGTH_BITS).bitwiseAND(F.lit(start_mask)).cast("int")

    def between(x: Column, y: Column) -> Column:
        first, last = F.shiftright(x, whole).cast("int"), F.shiftright(y, whole).cast("int")
        begin = start(x) + x.bitwiseAND(F.lit(length_mask)).cast("int")
        head = F.substr(F.get(pieces, first), begin + 1)
        among = F.when(last - first > 1, F.array_join(F.slice(pieces, first + 2, last - first - 1), "")).otherwise("")
        tail = F.when(start(y) > 0, F.substr(F.get(pieces, last), F.lit(1), start(y))).otherwise("")
        return F.when(first == last, F.substr(F.get(pieces, first), begin + 1, start(y) - begin)).otherwise(F.concat(F.coalesce(head, F.lit("")), among, tail))

    zero = F.lit(0).cast("long")
    return F.array_join(F.zip_with(F.concat(F.array(zero), cuts), F.concat(cuts, F.array(end)), between), "")


def gene_panel(genes: DataFrame, list_names: list[str], zeros: bool = False) -> DataFrame:
    """One row per dataset: symbols and list bits by gene position, and the usable positions.

    ``genes`` holds (dataset_id, gene_idx, symbol, in_<list>...), with gene_idx as in the columns of
    the dataset's matrix; places of numbers without a gene are null. ``symbols`` are null where the gene
    does not count (Ensembl-like symbols); ``usable`` (descending) are the positions that do count. All lists
    share small numbers with one bit each (``flags_0``, ...), so many lists make a row hardly longer than one. A row grows
    with the genes of one dataset (tens of thousands), never with its cells.

    With ``zeros`` there are ready-made texts too: of all genes that count (part ``""``) and of each list (part ``_0``, ...),
    as ``_pieces<part>`` of PIECE_WORDS words, and ``_cuts<part>`` by gene position, null where the gene is not in the part.
    """
    position = F.col("gene_idx").cast("int").alias("position")
    symbol = F.when(~is_ensembl_id(F.col("symbol")), F.col("symbol"))
    none = {"symbols": F.lit(None).cast("string")}
    flags: dict[str, Column] = {}
    for i, name in enumerate(list_names):
        column, bit = flag_column(i)
        own = F.when(F.col(quoted(f"in_{name}")) & symbol.isNotNull(), bit).otherwise(0)
        flags[column] = own if column not in flags else flags[column] + own
        none[column] = F.lit(0).cast("short")
    members: dict[str, Column] = {}
    if zeros:
        members = {"": symbol.isNotNull(), **{f"_{i}": F.col(quoted(f"in_{name}")) & symbol.isNotNull() for i, name in enumerate(list_names)}}
        genes = _with_cuts(genes, members)
        none |= {f"_cuts{part}": F.lit(None).cast("long") for part in members}
    ready = []
    for part in members:
        word = F.when(F.col(f"_member{part}"), F.struct(F.col(f"_rank{part}").alias("rank"), "symbol"))
        ready.append(F.sort_array(F.collect_list(word))["symbol"].alias(f"_words{part}"))
        ready.append(F.sort_array(F.collect_list(f"_starts{part}")).alias(f"_starts{part}"))
    entry = F.struct(position, symbol.alias("symbols"), *[c.cast("short").alias(n) for n, c in flags.items()], *[f"_cuts{part}" for part in members])
    usable = F.sort_array(F.collect_list(F.when(symbol.isNotNull(), position)), asc=False).alias("usable")
    panels = genes.groupBy("dataset_id").agg(F.sort_array(F.collect_list(entry)).alias("_genes"), usable, *ready)
    at = F.col("_genes.position")
    placed = panels.withColumn("_next", F.slice(at, F.lit(2), F.size("_genes")))

    def by_position(name: str) -> Column:
        """Every entry behind the empty places before it."""
        values = F.zip_with(
            F.arrays_zip(at.alias("position"), F.col("_genes")[name].alias("value")),
            "_next",
            lambda gene, following: F.concat(
                F.array(gene["value"]),
                F.array_repeat(none[name], F.coalesce(following - gene["position"] - 1, F.lit(0))),
            ),
        )
        before = F.array_repeat(none[name], F.coalesce(F.get("_genes.position", F.lit(0)), F.lit(0)))
        return F.concat(before, F.flatten(values)).alias(name)

    def pieces(part: str) -> Column:
        starts = F.col(f"_starts{part}")
        text = F.concat(F.array_join(f"_words{part}", " "), F.lit(" "))
        following = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.length(text).cast("long")))
        cut = F.zip_with(starts, F.slice(following, F.lit(1), F.size(starts)), lambda a, b: F.substr(text, (a + 1).cast("int"), (b - a).cast("int")))
        return cut.alias(f"_pieces{part}")

    return placed.select("dataset_id", "usable", *[by_position(n) for n in none], *[pieces(part) for part in members])
