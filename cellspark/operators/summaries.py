"""Dataset and species summaries of metadata tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.functions.ages import HUMAN, MOUSE
from cellspark.functions.text import organism_key
from cellspark.operators.columns import (
    ASSAY_COLUMNS,
    CELL_TYPE_COLUMNS,
    DISEASE_COLUMNS,
    DONOR_COLUMNS,
    SEX_COLUMNS,
    TISSUE_COLUMNS,
    first_present,
)
from cellspark.operators.publications import join_publications

# Output column pair (distinct count, value list) -> candidate source columns.
CATEGORY_FIELDS = {
    ("unique_tissues", "tissues"): TISSUE_COLUMNS,
    ("unique_cell_types", "cell_types"): CELL_TYPE_COLUMNS,
    ("unique_assays", "assays"): ASSAY_COLUMNS,
    ("unique_sexes", "sexes"): SEX_COLUMNS,
    ("unique_diseases", "diseases"): DISEASE_COLUMNS,
}
AGE_UNITS = ("years", "months")
MONTHS_COLUMNS = (
    "age_months_min",
    "age_months_max",
    "age_months_mean",
    "cells_with_age_months",
    "unique_ages_months",
)


def distinct_with_null(column: str) -> Column:
    """Aggregate: number of distinct values, a null counting as one of them."""
    return F.count_distinct(column) + F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))


def value_counts(df: DataFrame, column: str, by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*by, column).agg(F.count("*").alias("cells"))


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent values, ties by value; each task keeps only its own top ``n``."""
    return value_counts(df, column).orderBy(F.col("cells").desc(), F.col(column).asc()).limit(n)


def _combinations(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Distinct combinations of the columns with their number of cells.

    The one pass over the cells. It combines on the map side and spreads a large dataset over all
    of its combinations; everything after it works on this much smaller table.
    """
    return df.groupBy(*by, *columns).agg(F.count("*").alias("_n"))


def _listed(combos: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """``(by..., field, distinct, listed)``: distinct values of each column and their text list.

    The text is ``value: cells``, most cells first; for ages lowest age first. Nulls count as a
    distinct value but are not listed.
    """
    text = combos.select(*by, *[F.col(c).cast("string").alias(c) for c in columns], "_n")
    by_field = text.unpivot([*by, "_n"], columns, "field", "value")
    values = by_field.groupBy(*by, "field", "value").agg(F.sum("_n").alias("n"))
    is_age = F.col("field").startswith("age_")
    order = F.when(is_age, F.col("value").try_cast("double")).otherwise(-F.col("n").cast("double"))
    entry = F.struct(order.alias("o"), F.col("value"), F.concat_ws(": ", "value", F.col("n").cast("string")).alias("t"))
    is_listed = F.col("value").isNotNull() & ~F.col("field").isin(list(DONOR_COLUMNS))
    listed = F.array_join(F.sort_array(F.collect_list(F.when(is_listed, entry)))["t"], ", ")
    return values.groupBy(*by, "field").agg(
        F.count("*").alias("distinct"), F.when(listed != "", listed).alias("listed")
    )


def category_summary(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Distinct count and value list of each column, per group, in long form."""
    return _listed(_combinations(df, by, columns), by, columns)


def dataset_summaries(meta: DataFrame, by: str = "dataset_id") -> DataFrame:
    """One row per dataset: sizes, donors, age statistics, category counts and lists.

    Columns the metadata lack give typed nulls (0 for the counts of cells with an age).
    """
    donor = first_present(meta, DONOR_COLUMNS)
    ages = [f"age_{unit}" for unit in AGE_UNITS if f"age_{unit}" in meta.columns]
    categories = {outputs: first_present(meta, names) for outputs, names in CATEGORY_FIELDS.items()}
    listed_columns = [c for c in [donor, *categories.values(), *ages] if c is not None]
    organism = ["organism"] if "organism" in meta.columns else []
    combos = _combinations(meta, [by], [*organism, *listed_columns])

    known = F.min("organism") if organism else F.lit(HUMAN)
    stats = [F.sum("_n").alias("total_cells"), known.alias("organism")]
    for unit in AGE_UNITS:
        age = f"age_{unit}"
        if age in ages:
            cells = F.coalesce(F.sum(F.when(F.col(age).isNotNull(), F.col("_n"))), F.lit(0))
            mean = F.sum(F.col(age) * F.col("_n")) / F.nullif(cells, F.lit(0))
            stats += [
                F.min(age).alias(f"{age}_min"),
                F.max(age).alias(f"{age}_max"),
                F.round(mean, 2).alias(f"{age}_mean"),
                cells.alias(f"cells_with_{age}"),
            ]
        else:
            stats += [F.lit(None).cast("double").alias(f"{age}_{s}") for s in ("min", "max", "mean")]
            stats.append(F.lit(0).cast("bigint").alias(f"cells_with_{age}"))
    base = combos.groupBy(by).agg(*stats)

    def picked(field: str | None, column: str, dtype: str) -> Column:
        if field is None:
            return F.lit(None).cast(dtype)
        return F.max(F.when(F.col("field") == field, F.col(column)))

    lists = [picked(donor, "distinct", "bigint").alias("unique_donors")]
    for (count_name, list_name), source in categories.items():
        lists.append(picked(source, "distinct", "bigint").alias(count_name))
        lists.append(picked(source, "listed", "string").alias(list_name))
    for unit in AGE_UNITS:
        field = f"age_{unit}" if f"age_{unit}" in ages else None
        lists.append(picked(field, "listed", "string").alias(f"unique_ages_{unit}"))
    if not listed_columns:
        return mask_months(base.select("*", *lists))
    wide = _listed(combos, [by], listed_columns).groupBy(by).agg(*lists)
    same = F.col(f"a.{by}").eqNullSafe(F.col(f"b.{by}"))
    joined = base.alias("a").join(wide.alias("b"), same).drop(F.col(f"b.{by}"))
    return mask_months(joined)


def mask_months(summary: DataFrame) -> DataFrame:
    """Null the months columns of every row that is not a mouse dataset."""
    if "organism" not in summary.columns:
        return summary
    present = [c for c in MONTHS_COLUMNS if c in summary.columns]
    return summary.withColumns({c: F.when(F.col("organism") == MOUSE, F.col(c)) for c in present})


def order_by_known_ages(summary: DataFrame, count: str = "cells_with_age_years", tie: str = "dataset_id") -> DataFrame:
    """Datasets with most known ages first; missing counts as zero."""
    return summary.orderBy(F.coalesce(F.col(count), F.lit(0)).desc(), F.col(tie).asc())


def species_summary(meta: DataFrame, collections: DataFrame | None = None) -> DataFrame:
    """Summaries of all datasets in one aggregation, with publications, most known ages first."""
    summary = dataset_summaries(meta)
    if collections is not None:
        summary = join_publications(summary, collections)
    return order_by_known_ages(summary)


def by_organism(summary: DataFrame) -> DataFrame:
    """Add ``organism_key``; rows with a missing, empty or unknown organism go away."""
    named = F.col("organism").isNotNull() & ~F.col("organism").isin("", "unknown")
    return summary.filter(named).withColumn("organism_key", organism_key(F.col("organism")))
