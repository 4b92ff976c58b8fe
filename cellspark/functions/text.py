"""Name, path and text helpers, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENSEMBL_PREFIX = "ENS"
ENSEMBL_TOKEN_PATTERN = r"\bENS[A-Z]*\d+"
UUID_PATTERN = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
PORTAL_MARKERS = ("cellxgene", "cziscience")
MISSING_TEXT = "nan"


def quoted(name: str) -> str:
    """Column name in backticks, so that dots and blanks in it are taken as they are."""
    return "`" + name.replace("`", "``") + "`"


def is_ensembl_id(name: Column) -> Column:
    return name.startswith(ENSEMBL_PREFIX)


def has_ensembl_token(text: Column) -> Column:
    return text.rlike(ENSEMBL_TOKEN_PATTERN)


def sanitize_name(name: Column) -> Column:
    """File-system-safe name: all but letters, digits, ``-`` and ``.`` becomes ``_``; no ``_`` runs or outer ``_``."""
    safe = F.regexp_replace(name, r"[^\p{L}\p{N}_\-.]", "_")
    safe = F.regexp_replace(safe, "_+", "_")
    return F.regexp_replace(safe, "^_|_$", "")


def organism_key(organism: Column) -> Column:
    return F.translate(F.lower(organism), " -", "__")


def path_stem(path: Column) -> Column:
    """Last path part without its last extension."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]+)?/?$", 1)


def dataset_id_from_path(path: Column) -> Column:
    return F.replace(path_stem(path), F.lit("_meta"), F.lit(""))


def is_uuid(text: Column) -> Column:
    return text.rlike(UUID_PATTERN)


def looks_like_portal_path(path: Column) -> Column:
    """True for paths that name the data portal and for files named by a UUID."""
    lowered = F.lower(path)
    named = F.lit(False)
    for marker in PORTAL_MARKERS:
        named = named | lowered.contains(marker)
    return named | is_uuid(path_stem(path))


def hms(seconds: Column) -> Column:
    """Seconds as ``HH:MM:SS``."""
    whole = F.floor(seconds)
    return F.format_string(
        "%02d:%02d:%02d", F.floor(whole / 3600), F.floor(whole % 3600 / 60), whole % 60
    )


def megabytes(length: Column) -> Column:
    return length / F.lit(1024.0 * 1024.0)


def gigabytes(length: Column) -> Column:
    return length / F.lit(1024.0 * 1024.0 * 1024.0)


def utf8_text(value: Column) -> Column:
    """Byte string to text."""
    return F.decode(value, "UTF-8")


def truncated(text: Column, limit: int) -> Column:
    cut = F.concat(F.substring(text, 1, limit), F.lit("...[truncated]"))
    return F.when(F.length(text) > limit, cut).otherwise(text)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage; 0 where the whole is 0."""
    return F.when(whole > 0, F.round(part * 100.0 / whole, digits)).otherwise(F.lit(0.0))


def ratio(part: Column, whole: Column, digits: int) -> Column:
    return F.when(whole > 0, F.round(part / whole, digits)).otherwise(F.lit(0.0))
