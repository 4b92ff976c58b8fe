"""From expression, gene and cell tables to sentences with ages, publications and a split."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.functions.text import quoted
from cellspark.operators.ages import with_age_by_mode, with_known_age
from cellspark.operators.columns import DONOR_COLUMNS, fill_missing_text, first_present
from cellspark.operators.genes import flag_lists, map_genes, map_genes_without_table
from cellspark.operators.joins import BROADCAST_ROWS
from cellspark.operators.publications import PUBLICATION_COLUMNS, PUBLICATION_RENAMES, join_publications, publication_text
from cellspark.operators.sentences import sentences_from_arrays, to_sparse
from cellspark.operators.splits import split_dataset
from cellspark.session import materialize
from cellspark.sources.tables import TABLE_ROW, gene_list_names

CELL = ["dataset_id", "cell_id"]
# Counted size of publication records that every task may hold.
PUBLICATION_BYTES = 16 * 1024 * 1024


@dataclass(frozen=True)
class BuildOptions:
    """Options of a dataset build; the defaults are those of the command line it replaces."""

    top_n: int | None = 2000
    list_names: tuple[str, ...] = ()
    include_all: bool = True
    include_zeros: bool = True
    use_hgnc: bool = True
    age_mode: str = "years"
    filter_by_age: bool = True
    test_size: float = 0.05
    seed: int = 42
    stratify_by_age: bool = True
    skip_split: bool = False
    # Bring the cells of one output folder together before sentences are built, not after.
    cluster_output: bool = False
    # Which of several symbols of one gene id is kept: the first in this order of columns. By default the
    # first line of the symbol table, where its reader has numbered them, else the first in the alphabet.
    symbol_order: tuple[str, ...] | None = None


def with_list_names(options: BuildOptions, gene_lists: DataFrame | None) -> BuildOptions:
    """Options with all lists of the table, unless some are named; there are as many as list files."""
    if gene_lists is None or options.list_names:
        return options
    return replace(options, list_names=tuple(gene_list_names(gene_lists)))


def gene_symbols(var: DataFrame, symbols: DataFrame | None, gene_lists: DataFrame | None, options: BuildOptions):
    """Genes of all datasets with symbol and list membership."""
    if options.use_hgnc and symbols is not None:
        default = [TABLE_ROW if TABLE_ROW in symbols.columns else "symbol"]
        mapped = map_genes(var, symbols, list(options.symbol_order or default))
    else:
        mapped = map_genes_without_table(var)
    flags = [quoted(f"in_{n}") for n in options.list_names]
    flagged = flag_lists(mapped, gene_lists, list(options.list_names))
    return flagged.select("dataset_id", "gene_idx", "symbol", *flags)


def cell_metadata(obs: DataFrame, collections: DataFrame | None, options: BuildOptions) -> DataFrame:
    """Cells with text nulls filled, age, publication columns and, unless skipped, their side.

    All filtering and splitting happens here, on narrow rows, before any sentence exists.
    """
    cells = fill_missing_text(with_age_by_mode(obs, options.age_mode))
    if collections is not None:
        cells = publication_text(join_publications(cells, collections))
    if options.filter_by_age:
        cells = with_known_age(cells)
    if options.skip_split:
        return cells
    return split_dataset(cells, CELL, "age", options.test_size, options.seed, options.stratify_by_age)


def with_sentences(
    cells: DataFrame, expr: DataFrame | None, genes: DataFrame, options: BuildOptions
) -> DataFrame:
    """Add the sentences to ``cells``; ``expr`` is in long or array form, by the columns it has.

    Without ``expr`` the cells hold the arrays themselves, and nothing has to be joined by cell.
    Long form becomes array form in one shuffle by cell, which the join with the cells then shares.
    Cells and expression meet while expression is still numbers: those are a fraction of the size of
    sentences, and cells left out earlier get no sentence built. A cell without expression rows has
    only zeros; a cell that stands twice in ``cells`` gets its sentence twice.
    """
    variants = {"top_n": options.top_n, "list_names": options.list_names, "include_all": options.include_all}
    if expr is None:
        measured = cells
    else:
        measured = cells.join(to_sparse(expr, CELL) if "gene_idx" in expr.columns else expr, CELL, "left")
    folder = [c for c in ("dataset_id", "split") if c in measured.columns] if options.cluster_output else None
    return sentences_from_arrays(measured, genes, CELL, include_zeros=options.include_zeros, cluster_by=folder, **variants)


def of_kept_cells(expr: DataFrame, cells: DataFrame) -> DataFrame:
    """Expression rows of the cells that are left; ``cells`` are stored.

    Up to BROADCAST_ROWS cells, which are counted, are broadcast, so rows of other cells are gone before anything
    moves. Beyond that whole datasets without a cell left go first (there are few datasets), and rows in long form meet
    their cells in the shuffle by cell that gathers them anyway.
    """
    keys = cells.select(*CELL).distinct()
    if keys.count() <= BROADCAST_ROWS:
        return expr.join(F.broadcast(keys), CELL, "left_semi")
    datasets = keys.select("dataset_id").distinct()
    rows = expr.join(F.broadcast(datasets), "dataset_id", "left_semi") if datasets.count() <= BROADCAST_ROWS else expr
    return rows.join(keys, CELL, "left_semi") if "gene_idx" in expr.columns else rows


def publications_come_last(obs: DataFrame, collections: DataFrame | None, options: BuildOptions) -> bool:
    """May publications be joined to the finished sentences, by broadcast?

    Then their columns move with no shuffle, and a cell of several collections gets its sentence made once. Not where a
    side depends on how often a cell stands in ``obs`` with its publications: quotas follow the donors' median ages.
    """
    if collections is None or "dataset_id" not in obs.columns or set(PUBLICATION_COLUMNS) & set(obs.columns):
        return False
    size = sum(F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in PUBLICATION_RENAMES)
    found = collections.agg(F.sum(size).alias("bytes"), (F.count_distinct("dataset_id") == F.count("dataset_id")).alias("once")).first()
    quotas = options.stratify_by_age and not options.skip_split and first_present(obs, DONOR_COLUMNS) is not None
    return (found["bytes"] or 0) <= PUBLICATION_BYTES and (found["once"] or not quotas)


def with_publications(built: DataFrame, collections: DataFrame, before: list[str]) -> DataFrame:
    """Finished sentences with publication columns, a row for every collection of a cell's dataset; they follow the columns ``before``."""
    joined = publication_text(join_publications(built, F.broadcast(collections)))
    at = max(i for i, c in enumerate(built.columns, 1) if c in before)
    return joined.select(*[quoted(c) for c in [*built.columns[:at], *PUBLICATION_COLUMNS, *built.columns[at:]]])


def build_dataset(
    obs: DataFrame,
    var: DataFrame,
    expr: DataFrame | None = None,
    symbols: DataFrame | None = None,
    collections: DataFrame | None = None,
    gene_lists: DataFrame | None = None,
    options: BuildOptions | None = None,
) -> DataFrame:
    """One row per kept cell of every dataset: metadata, age, publications, sentences, split."""
    options = with_list_names(options or BuildOptions(), gene_lists)
    genes = gene_symbols(var, symbols, gene_lists, options)
    last = publications_come_last(obs, collections, options)
    cells = cell_metadata(obs, None if last else collections, options)
    if expr is not None and options.filter_by_age:
        cells = materialize(cells.sparkSession, cells, "kept-cells")
        expr = of_kept_cells(expr, cells)
    built = with_sentences(cells, expr, genes, options)
    return with_publications(built, collections, [*obs.columns, "age", "age_years", "age_months"]) if last else built


def convert_dataset(
    obs: DataFrame,
    var: DataFrame,
    expr: DataFrame | None = None,
    symbols: DataFrame | None = None,
    gene_lists: DataFrame | None = None,
    options: BuildOptions | None = None,
) -> DataFrame:
    """Sentences and metadata of all cells: no age filter, no publications, no split."""
    options = with_list_names(options or BuildOptions(), gene_lists)
    genes = gene_symbols(var, symbols, gene_lists, options)
    return with_sentences(fill_missing_text(obs), expr, genes, options)
