"""Publication records of datasets: flatten, join, existence, match rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.functions.text import looks_like_portal_path, percent
from cellspark.operators.columns import fill_missing_text
from cellspark.operators.joins import lookup_join

# Collection column -> name in joined tables.
PUBLICATION_RENAMES = {
    "collection_id": "collection_id",
    "title": "publication_title",
    "doi": "publication_doi",
    "description": "publication_description",
    "contact_name": "publication_contact_name",
    "contact_email": "publication_contact_email",
}
PUBLICATION_COLUMNS = list(PUBLICATION_RENAMES.values())

COLLECTION_SCHEMA = (
    "collection_id string, name string, doi string, description string, contact_name string, "
    "contact_email string, datasets array<struct<id:string, dataset_id:string>>"
)


def _text_or_null(column: Column) -> Column:
    return F.when(column != "", column)


def flatten_collections(collections: DataFrame) -> DataFrame:
    """Nested collections -> one row per dataset; datasets without any id are dropped."""
    rows = collections.withColumn("_dataset", F.explode("datasets"))
    dataset_id = F.coalesce(_text_or_null(F.col("_dataset.id")), _text_or_null(F.col("_dataset.dataset_id")))

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    return rows.select(
        dataset_id.alias("dataset_id"),
        "collection_id",
        text("name").alias("title"),
        "doi",
        text("description").alias("description"),
        text("contact_name").alias("contact_name"),
        text("contact_email").alias("contact_email"),
    ).filter(F.col("dataset_id").isNotNull())


def parse_collections(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON text, one collection per row, -> flattened rows."""
    return flatten_collections(lines.select(F.from_json(column, COLLECTION_SCHEMA).alias("c")).select("c.*"))


def join_publications(df: DataFrame, collections: DataFrame) -> DataFrame:
    """Left join of publication columns on ``dataset_id``; a dataset in two collections gives two rows."""
    if "dataset_id" not in df.columns:
        raise ValueError(f"A dataset_id column is needed to join publications; columns: {df.columns}")
    if "collection_id" in df.columns:
        return df
    renamed = collections.select("dataset_id", *[F.col(c).alias(n) for c, n in PUBLICATION_RENAMES.items()])
    return lookup_join(df, renamed, ["dataset_id"])


def publication_text(df: DataFrame) -> DataFrame:
    """Publication columns as text with the missing-text filler."""
    present = [c for c in PUBLICATION_COLUMNS if c in df.columns]
    return fill_missing_text(df.withColumns({c: F.col(c).cast("string") for c in present}), present)


def match_rate(joined: DataFrame) -> DataFrame:
    total, matched = F.count("*"), F.count("collection_id")
    return joined.agg(
        total.alias("total_rows"),
        matched.alias("rows_with_metadata"),
        percent(matched, total).alias("match_percentage"),
    )


def known_datasets(datasets: DataFrame, collections: DataFrame) -> DataFrame:
    """Rows whose dataset has a publication record."""
    return datasets.join(collections.select("dataset_id"), "dataset_id", "left_semi")


def flag_known_datasets(datasets: DataFrame, collections: DataFrame) -> DataFrame:
    """Add ``in_collections``."""
    known = collections.select("dataset_id").distinct().withColumn("in_collections", F.lit(True))
    flagged = lookup_join(datasets, known, ["dataset_id"])
    return flagged.withColumn("in_collections", F.coalesce("in_collections", F.lit(False)))


def portal_datasets(files: DataFrame, path: str = "path") -> DataFrame:
    """Rows whose path looks like a file of the data portal."""
    return files.filter(looks_like_portal_path(F.col(path)))
