"""What a file path says about the file: relative path, merchant, date."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The date format of file names and the name of files without a merchant folder.
FILE_DATE = r"(?i)((?!0000)\d{4}_\d{2}_\d{2})\.csv$"
FILE_DATE_FORMAT = "yyyy_MM_dd"
NO_MERCHANT = "unknown"

SCHEME_AND_BUCKET = r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*/|/(?!/))"


def relative_path(path: Column, base: str | None = None) -> Column:
    """Path below the bucket, or below ``base`` if given; a path without a scheme stays as it is."""
    stripped = F.regexp_replace(path, SCHEME_AND_BUCKET, "")
    if base is None:
        return stripped
    prefix = re.sub(SCHEME_AND_BUCKET, "", base).strip("/")
    if not prefix:
        return stripped
    bare = F.ltrim(stripped, F.lit("/"))
    return F.when(bare.startswith(prefix + "/"), F.substr(bare, F.lit(len(prefix) + 2))).otherwise(stripped)


def merchant(path: Column) -> Column:
    """Second segment of a relative path (of ``a/b`` that is the file itself)."""
    return F.coalesce(F.get(F.split(path, "/"), F.lit(1)), F.lit(NO_MERCHANT))


def file_date(path: Column) -> Column:
    """Date at the end of a CSV file name; NULL if there is none or the calendar has no such day."""
    return F.try_to_date(F.regexp_extract(path, FILE_DATE, 1), FILE_DATE_FORMAT)


def whole_match(path: Column, pattern: str) -> Column:
    """Regular expression match on the whole path."""
    return path.rlike(f"^(?:{pattern})$")


def decoded_uri(uri: Column) -> Column:
    """Readable path of ``_metadata.file_path``, with one spelling for local files."""
    text = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(text, "^file:/+", "file:/")


def glob_escaped(path: str) -> str:
    """Path that ``spark.read`` takes literally."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)
