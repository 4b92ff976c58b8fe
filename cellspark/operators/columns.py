"""Column selection, typing and null handling for metadata tables with changing schemas."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.functions.text import MISSING_TEXT, quoted, truncated

# Candidate column names, first present one wins.
DONOR_COLUMNS = ("donor_id", "donor", "subject_id", "individual")
TISSUE_COLUMNS = ("tissue", "tissue_type", "organ", "tissue_general")
CELL_TYPE_COLUMNS = ("cell_type", "cell_type_ontology_term_id", "celltype")
ASSAY_COLUMNS = ("assay", "assay_ontology_term_id", "technology", "platform")
SEX_COLUMNS = ("sex", "sex_ontology_term_id", "gender")
DISEASE_COLUMNS = ("disease", "disease_ontology_term_id", "condition")
INDEX_COLUMN = "index"

# Storage encoding of a metadata column -> type it is read as.
ENCODING_TYPES = {
    "categorical": T.StringType(),
    "string-array": T.StringType(),
    "nullable-string-array": T.StringType(),
    "nullable-boolean": T.BooleanType(),
    "nullable-integer": T.LongType(),
}
KIND_TYPES = {
    "b": T.BooleanType(),
    "i": T.LongType(),
    "u": T.LongType(),
    "f": T.DoubleType(),
}


def first_present(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """First of ``candidates`` that is a column of ``df``."""
    return next((name for name in candidates if name in df.columns), None)


def missing_fields(df: DataFrame, fields: Iterable[str]) -> list[str]:
    return [name for name in fields if name not in df.columns]


def select_fields(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Keep the requested columns that exist (default: all but the index column)."""
    wanted = [c for c in df.columns if c != INDEX_COLUMN] if fields is None else fields
    kept = [name for name in wanted if name in df.columns]
    if not kept:
        raise ValueError(f"None of the requested fields exist: {wanted}; available: {df.columns}")
    return df.select(*map(quoted, kept))


def encoded_type(encoding: str, kind: str | None = None) -> T.DataType | None:
    """Spark type for a stored column; None for nested groups, which have no plain type."""
    if encoding in ENCODING_TYPES:
        return ENCODING_TYPES[encoding]
    if kind is None:
        return None
    return KIND_TYPES.get(kind, T.StringType())


def schema_from_encodings(encodings: Mapping[str, tuple[str, str | None]]) -> T.StructType:
    """Schema for ``{column: (encoding, kind)}``, leaving out the index and nested groups."""
    fields = []
    for name, (encoding, kind) in encodings.items():
        dtype = encoded_type(encoding, kind)
        if name != INDEX_COLUMN and dtype is not None:
            fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns named in ``schema``; a value that does not fit becomes null."""
    casts = {f.name: F.col(quoted(f.name)).try_cast(f.dataType) for f in schema if f.name in df.columns}
    return df.withColumns(casts) if casts else df


def type_untyped_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give all-null columns without a type the type the schema names."""
    untyped = {f.name for f in df.schema if isinstance(f.dataType, T.NullType)}
    casts = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name in untyped}
    return df.withColumns(casts) if casts else df


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def fill_missing_text(df: DataFrame, columns: list[str] | None = None, text: str = MISSING_TEXT) -> DataFrame:
    """Replace nulls of text columns by ``text``; numbers and booleans keep their nulls."""
    names = string_columns(df) if columns is None else columns
    return df.withColumns({n: F.coalesce(quoted(n), F.lit(text)) for n in names}) if names else df


def decode_codes(code: Column, categories: Column) -> Column:
    """Dictionary code -> category; negative codes and missing dictionaries -> null."""
    return F.when((code >= 0) & (code < F.size(categories)), F.get(categories, code))


def decode_mask(value: Column, masked: Column) -> Column:
    return F.when(~masked, value)


def decode_codes_by_join(df: DataFrame, code: str, dictionary: DataFrame, name: str) -> DataFrame:
    """Dictionary decode with the dictionary as a table ``(code, category)``."""
    entries = dictionary.select(F.col("code").alias(code), F.col("category").alias(name))
    return df.join(entries, code, "left").drop(code)


def attach_by_position(df: DataFrame, index: str, values: DataFrame, name: str) -> DataFrame:
    """Attach a stored column to rows by position; ``values`` is a table (position, value), one row per position."""
    position, value = values.columns
    by_row = values.select(F.col(quoted(position)).cast("bigint").alias(index), F.col(quoted(value)).alias(name))
    return df.join(by_row, index, "left")


def attach_scalar(df: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """Repeat the single value of a one-row table on every row."""
    return df.withColumn(name, values.select(values.columns[0]).scalar())


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add each missing column as typed nulls."""
    absent = {n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df


def _shortened(column: Column, kind: T.DataType, text_limit: int, item_limit: int) -> Column:
    """Long text and bytes cut, long lists and maps cut, and what is inside them as well."""
    if isinstance(kind, T.StringType):
        return truncated(column, text_limit)
    if isinstance(kind, T.BinaryType):
        return F.substring(column, 1, text_limit)
    if isinstance(kind, T.ArrayType):
        return F.transform(F.slice(column, 1, item_limit), lambda x: _shortened(x, kind.elementType, text_limit, item_limit))
    if isinstance(kind, T.MapType):
        few = F.map_from_entries(F.slice(F.map_entries(column), 1, item_limit))
        return F.transform_values(few, lambda _, v: _shortened(v, kind.valueType, text_limit, item_limit))
    if isinstance(kind, T.StructType):
        fields = [_shortened(column.getField(f.name), f.dataType, text_limit, item_limit).alias(f.name) for f in kind]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


def sample_rows(
    df: DataFrame, order: list[str], rows: int = 5, text_limit: int = 200, item_limit: int = 8
) -> DataFrame:
    """First rows for diagnosis, with long text, bytes, lists and maps cut at every depth."""
    cut = [_shortened(F.col(quoted(f.name)), f.dataType, text_limit, item_limit).alias(f.name) for f in df.schema]
    return df.orderBy(*order).limit(rows).select(*cut)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in ``order``. Combines on the map side, unlike a window."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(first).select(*keys, "_row.*").select(*df.columns)


def share_of_total(df: DataFrame, count: str, name: str, digits: int = 2) -> DataFrame:
    """Add each row's percentage of the column total."""
    total = df.agg(F.sum(count).alias("total")).select("total").scalar()
    return df.withColumn(name, F.when(total > 0, F.round(F.col(count) * 100.0 / total, digits)).otherwise(0.0))
