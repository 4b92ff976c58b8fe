"""Metadata extraction and re-splitting of converted datasets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.operators.ages import age_distribution, null_age_stats, thin_ages, with_known_age, with_species_ages
from cellspark.operators.columns import (
    DONOR_COLUMNS,
    ensure_columns,
    fill_missing_text,
    first_present,
    select_fields,
)
from cellspark.operators.publications import join_publications
from cellspark.operators.splits import donor_statistics, split_dataset, split_statistics
from cellspark.operators.summaries import dataset_summaries, order_by_known_ages, species_summary
from cellspark.session import materialize
from cellspark.sinks.parquet import write_parquet
from cellspark.sinks.summaries import separator_for, write_by_organism, write_summary

AGE_COLUMNS = {"age_years": "double", "age_months": "double"}


def extract_metadata(
    obs: DataFrame,
    fields: list[str] | None = None,
    dataset_id: str | None = None,
    collections: DataFrame | None = None,
    extract_age: bool = True,
    age_source: str = "development_stage",
) -> DataFrame:
    """Chosen metadata columns with filled text, both age columns, dataset id and publications.

    Ages come from the chosen columns only; without a stage column among them they are null.
    """
    cells = fill_missing_text(select_fields(obs, fields))
    if extract_age:
        cells = ensure_columns(with_species_ages(cells, age_source), AGE_COLUMNS)
    if dataset_id is not None and "dataset_id" not in cells.columns:
        cells = cells.withColumn("dataset_id", F.lit(dataset_id))
    if collections is not None:
        cells = join_publications(cells, collections)
    return cells


def store_metadata(meta: DataFrame, path: str, summary_path: str | None = None, fmt: str = "csv") -> DataFrame:
    """Write extracted metadata and, if wanted, the summary of what was written; returns the stored table."""
    if summary_path is not None:
        separator_for(fmt)  # an unknown format is an error before anything is written
    write_parquet(meta, path)
    stored = meta.sparkSession.read.schema(meta.schema).parquet(path)
    if summary_path is not None:
        write_summary(dataset_summaries(stored), summary_path, fmt)
    return stored


def store_species_summary(meta: DataFrame, path: str, collections: DataFrame | None = None, fmt: str = "csv") -> None:
    """``<path>/all_datasets_summary`` and one ``<path>/by_organism/organism_key=...`` folder per organism."""
    separator_for(fmt)
    summary = materialize(meta.sparkSession, species_summary(meta, collections), "species-summary")
    ordered = order_by_known_ages(summary)
    write_summary(ordered, f"{path}/all_datasets_summary", fmt)
    write_by_organism(ordered, f"{path}/by_organism", fmt)


@dataclass(frozen=True)
class SplitResult:
    """A split dataset with the figures that describe it."""

    cells: DataFrame
    filtering: DataFrame
    thin_ages: DataFrame
    donors: DataFrame | None
    sides: DataFrame
    ages_by_side: DataFrame


def resplit_dataset(
    cells: DataFrame,
    cell: list[str],
    age: str = "age",
    test_size: float = 0.05,
    seed: int = 42,
) -> SplitResult:
    """Split an existing dataset by donor (by cell if it has none), with statistics as lazy tables."""
    kept = with_known_age(cells, age)
    donor = first_present(kept, DONOR_COLUMNS)
    split = split_dataset(kept, cell, age, test_size, seed)
    return SplitResult(
        cells=split,
        filtering=null_age_stats(cells, age),
        thin_ages=thin_ages(cells, test_size, age),
        donors=None if donor is None else donor_statistics(kept, donor),
        sides=split_statistics(split),
        ages_by_side=age_distribution(split, age, by=("split",)),
    )
