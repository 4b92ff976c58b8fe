"""Ages of cells: extraction, null-age statistics, thin age groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.functions.ages import HUMAN, MOUSE, age_in_months, age_in_years
from cellspark.functions.text import percent


def with_age(df: DataFrame, source: str = "development_stage", name: str = "age") -> DataFrame:
    """Add age in years from stage text, replacing any present ``name``; null without a source column."""
    if source not in df.columns:
        return df.withColumn(name, F.lit(None).cast("double"))
    return df.withColumn(name, age_in_years(F.col(source)))


def with_species_ages(df: DataFrame, source: str = "development_stage") -> DataFrame:
    """Add ``age_years`` (human) and ``age_months`` (mouse).

    Present values win over extracted ones; a plain ``age`` column is the last choice for months.
    Without an organism column both are tried on every row. Both columns are always in the result,
    so that the schema does not depend on which species the rows hold.
    """
    null = F.lit(None).cast("double")
    species_known = "organism" in df.columns
    human = F.col("organism") == HUMAN if species_known else F.lit(True)
    mouse = F.col("organism") == MOUSE if species_known else F.lit(True)

    years = [F.col("age_years").try_cast("double")] if "age_years" in df.columns else []
    months = [F.col("age_months").try_cast("double")] if "age_months" in df.columns else []
    if source in df.columns:
        years.append(F.when(human, age_in_years(F.col(source))))
        months.append(F.when(mouse, age_in_months(F.col(source))))
    if "age" in df.columns:
        months.append(F.when(mouse, F.col("age").try_cast("double")))
    return df.withColumns({"age_years": F.coalesce(*years, null), "age_months": F.coalesce(*months, null)})


def with_age_by_mode(df: DataFrame, mode: str = "years", source: str = "development_stage") -> DataFrame:
    """``mode="years"``: years only. ``mode="species"``: months / 12 where only months are known."""
    if mode == "years":
        return with_age(df, source)
    if mode == "species":
        aged = with_species_ages(df, source)
        return aged.withColumn("age", F.coalesce("age_years", F.col("age_months") / 12))
    raise ValueError(f"Unknown age mode: {mode}")


def with_known_age(df: DataFrame, age: str = "age") -> DataFrame:
    return df.filter(F.col(age).isNotNull())


def null_age_stats(df: DataFrame, age: str = "age") -> DataFrame:
    """Cells before and after the age filter, discarded cells and their percentage."""
    total, nulls = F.count("*"), F.count_if(F.col(age).isNull())
    return df.agg(
        total.alias("cells_before_filtering"),
        F.count(age).alias("cells_after_filtering"),
        nulls.alias("cells_discarded"),
        percent(nulls, total).alias("discard_percentage"),
    )


def null_age_sample(df: DataFrame, order: str, source: str = "development_stage", age: str = "age", rows: int = 10):
    """First cells, in key order, whose stage gave no age."""
    return df.filter(F.col(age).isNull()).orderBy(order).limit(rows).select(order, source, age)


def age_distribution(df: DataFrame, age: str = "age", by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*by, age).agg(F.count("*").alias("cells"))


def thin_ages(df: DataFrame, test_size: float, age: str = "age") -> DataFrame:
    """Ages with fewer cells than a split of this size needs."""
    needed = int(1 / test_size) if test_size > 0 else 2
    return age_distribution(with_known_age(df, age), age).filter(F.col("cells") < needed)


def age_range_violations(df: DataFrame, age: str = "age", low: float = 0.0, high: float = 150.0) -> DataFrame:
    """Smallest and largest age and the number of ages outside the allowed range."""
    return df.agg(
        F.min(age).alias("age_min"),
        F.max(age).alias("age_max"),
        F.count_if(~F.col(age).between(low, high)).alias("out_of_range"),
    )
