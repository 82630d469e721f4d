"""Value rules of the patch run: blanks, time zones, fee lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from moorage.functions.documents import as_variant, field, json_ready, object_entries, once, strict_json

# The list field and the number inside its objects.
FEES_FIELD = "fees"
FEE_AMOUNT = "feeAmount"

WHITESPACE = " \t\n\r\x0b\x0c"
NUMBER_TEXT = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)$"


def not_blank(value: Column, kind: T.DataType) -> Column:
    """The value, or NULL if it is text with nothing but white space."""
    if isinstance(kind, T.StringType):
        return F.when(F.trim(value, F.lit(WHITESPACE)) != "", value)
    return value


def utc_timestamp(value: Column, kind: T.DataType) -> Column:
    """A timestamp without zone read as UTC, whatever the zone of the session."""
    if not isinstance(kind, T.TimestampNTZType):
        return value
    seconds = (value - F.lit("1970-01-01").cast("timestamp_ntz")).cast("interval second").cast("decimal(20,6)")
    return F.timestamp_micros((seconds * 1000000).cast("bigint"))


def fee_amount(value: Column) -> Column:
    """A fee amount as DOUBLE; 0.0 for whatever is not a number."""
    text = F.trim(F.try_variant_get(value, "$", "string"), F.lit(WHITESPACE))
    text = F.regexp_replace(text, r"(?<=\d)_(?=\d)", "")
    number = F.when(
        F.schema_of_variant(value) == "STRING", F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))
    ).otherwise(F.try_variant_get(value, "$", "double"))
    return F.coalesce(number, F.lit(0.0))


def _with_amount(item: Column) -> Column:
    amount = field(item, FEE_AMOUNT)
    others = F.map_filter(object_entries(item), lambda k, _: k != FEE_AMOUNT)
    changed = F.to_variant_object(
        F.map_concat(others, F.create_map(F.lit(FEE_AMOUNT), as_variant(fee_amount(amount))))
    )
    return F.when(amount.isNotNull(), changed).otherwise(item)


def _is_empty(value: Column) -> Column:
    """Values that stand for no fee at all: null, false, zero, empty text, empty object."""
    kind = F.schema_of_variant(value)
    return (
        F.is_variant_null(value)
        | F.coalesce((kind == "BOOLEAN") & ~F.try_variant_get(value, "$", "boolean"), F.lit(False))
        | F.coalesce((kind == "STRING") & (F.try_variant_get(value, "$", "string") == ""), F.lit(False))
        | F.coalesce(kind.rlike("^[BDFIST]") & (kind != "STRING") & (kind != "BOOLEAN")
                     & (F.try_variant_get(value, "$", "double") == 0), F.lit(False))
        | F.coalesce(F.size(object_entries(value)) == 0, F.lit(False))
    )


def fee_list(value: Column, kind: T.DataType) -> Column:
    """Fees as ARRAY<VARIANT>: JSON text is parsed, one fee becomes a list, what cannot be read becomes ``[]``.

    NULL and blank text give NULL.
    """
    if isinstance(kind, T.StringType):
        parsed = strict_json(value)
        present = not_blank(value, kind).isNotNull()
    else:
        ready = json_ready(value, kind)
        nested = isinstance(kind, (T.ArrayType, T.MapType, T.StructType))
        parsed = F.to_variant_object(ready) if nested else as_variant(ready)
        present = value.isNotNull()
    nothing = F.array().cast("array<variant>")

    def items(parsed: Column) -> Column:
        listed = (
            F.when(parsed.isNull(), nothing)
            .when(F.schema_of_variant(parsed).startswith("ARRAY"), F.try_variant_get(parsed, "$", "array<variant>"))
            .when(_is_empty(parsed), nothing)
            .otherwise(F.array(parsed))
        )
        return F.transform(listed, _with_amount)

    return F.when(present, once(parsed, items))
