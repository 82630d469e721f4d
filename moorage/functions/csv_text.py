"""Expressions on CSV headers and rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def cells_schema(width: int) -> str:
    """Positional text columns."""
    return ", ".join(f"c{i} string" for i in range(1, width + 1))


def cells_array(width: int, prefix: str = "") -> Column:
    return F.array(*[F.col(f"{prefix}c{i}") for i in range(1, width + 1)])


def width_class(cells: Column) -> Column:
    """Number of columns to parse with: the least power of two that leaves room for a surplus cell, 16 at least."""
    return F.pow(F.lit(2), F.greatest(F.lit(4), F.ceil(F.log2(cells + 1)))).cast("int")


def cell_count(record: Column, sep: str = ",") -> Column:
    """Cells of a record at most: separators within quotes are counted as well."""
    return F.length(record) - F.length(F.replace(record, F.lit(sep), F.lit(""))) + 1


def ends_in_quotes(content: Column, sep: str = ",", encoding: str = "UTF-8") -> Column:
    """Whether a whole CSV text leaves a quoted cell open at its end."""
    text = content.cast("string") if encoding.upper() == "UTF-8" else F.decode(content, encoding)
    # A line break ends a cell as a separator does, and neither counts within quotes.
    return F.contains(text, F.lit('"')) & leaves_quote_open(F.replace(text, F.lit("\n"), F.lit(sep)), sep)


def first_record(content: Column, encoding: str = "UTF-8") -> Column:
    """Text of the first CSV record of a file, line breaks inside quotes included."""
    text = content.cast("string") if encoding.upper() == "UTF-8" else F.decode(content, encoding)
    text = F.ltrim(text, F.lit("\ufeff\r\n"))
    line = F.substring_index(text, "\n", 1)
    odd = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
    record = F.when(~odd, line).otherwise(
        F.regexp_extract(text, r'^(?>[^"\n]+|"[^"]*+")*+', 0)
    )
    return F.rtrim(record, F.lit("\r"))


def leaves_quote_open(line: Column, sep: str = ",") -> Column:
    """Whether a line that starts outside quotes ends inside a quoted cell.

    Doubled quotes are dropped, then every complete cell; a quote that is left opened a cell. A quote
    counts only at the start of a cell. For a line that starts inside quotes, put a quote before it.
    """
    if len(sep) != 1:
        raise ValueError("files read in splits need a separator of one character")
    s = re.escape(sep)
    cell = rf'(?:"[^"]*+"[^{s}]*+|[^"{s}][^{s}]*+)?+(?:{s}|$)'
    single = F.replace(line, F.lit('""'), F.lit(""))
    return F.contains(single, F.lit('"')) & F.contains(F.regexp_replace(single, cell, ""), F.lit('"'))


def header_names(cells: Column) -> Column:
    """Column names of a header row: quotes stripped, empty names numbered, nothing past the last name."""
    width = F.array_max(F.transform(cells, lambda x, i: F.when(x.isNotNull(), i + 1).otherwise(0)))
    return F.transform(
        F.slice(cells, F.lit(1), width),
        lambda x, i: F.when(
            x.isNull() | (x == ""), F.concat(F.lit("column_"), (i + 1).cast("string"))
        ).otherwise(F.trim(x, F.lit('"'))),
    )


def header_problem(names: Column, max_columns: int | None = None) -> Column:
    """Why a file with these column names cannot be loaded, or NULL."""
    too_wide = F.lit(False) if max_columns is None else F.size(names) > max_columns
    return (
        F.when(names.isNull(), "could_not_read_header")
        .when(F.size(names) == 0, "no_columns")
        .when(too_wide, "too_many_columns")
        .when(F.size(F.array_distinct(names)) < F.size(names), "duplicate_columns")
    )


def row_object(names: Column, cells: Column) -> Column:
    """Row as VARIANT object; all cells stay text, missing ones are null, surplus ones are left out."""
    return F.to_variant_object(F.map_from_arrays(names, F.slice(cells, F.lit(1), F.size(names))))


def has_surplus(names: Column, cells: Column) -> Column:
    """Whether a row holds anything beyond the named columns."""
    return F.exists(F.slice(cells, F.size(names) + 1, F.lit(1 << 30)), lambda x: x.isNotNull())
