"""Document-store filter dicts as Spark conditions.

Comparisons hold only between values of one kind (number, text, boolean), as in the store: the text "5"
is not a number. A field holding an array also matches if one of its elements does, and a path goes
through arrays of objects to any element, or to one by its number. ``{"f": None}`` matches a null or
missing field. ``$regex``, ``$mod`` and ``$type`` look at the field and at the elements of its array in the same way;
``$size``, ``$all`` and ``$elemMatch`` are about arrays. Patterns are Java's.

A filter on a table of typed columns is split in two: what columns alone can tell, as conditions that reach the scan,
and the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, functions as F, types as T

from moorage.functions.documents import field

NUMBER_KINDS = "^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"
WHOLE_KINDS = "^(BIGINT|INT|SMALLINT|TINYINT)"
# Names of types in filters, as patterns of the kinds a VARIANT tells.
TYPE_KINDS = {
    "number": NUMBER_KINDS,
    "int": WHOLE_KINDS,
    "long": WHOLE_KINDS,
    "double": "^(DOUBLE|FLOAT)",
    "decimal": "^DECIMAL",
    "string": "^STRING",
    "bool": "^BOOLEAN",
    "object": "^OBJECT",
    "array": "^ARRAY",
    "null": "^VOID",
    "date": "^(DATE|TIMESTAMP)",
    "binData": "^BINARY",
}
COMPARISONS = {"$eq", "$ne", "$gt", "$gte", "$lt", "$lte", "$in", "$nin"}


def _compare(op: str, left: Column, right: Any) -> Column:
    return {
        "$eq": lambda: left == right,
        "$gt": lambda: left > right,
        "$gte": lambda: left >= right,
        "$lt": lambda: left < right,
        "$lte": lambda: left <= right,
    }[op]()


def _scalar(op: str, value: Column, operand: Any) -> Column:
    kind = F.schema_of_variant(value)
    if operand is None:
        return F.is_variant_null(value) if op in ("$eq", "$gte", "$lte") else F.lit(False)
    if isinstance(operand, bool):
        return (kind == "BOOLEAN") & _compare(op, F.try_variant_get(value, "$", "boolean"), F.lit(operand))
    if isinstance(operand, (int, float)):
        exact = F.try_variant_get(value, "$", "bigint")
        near = F.try_variant_get(value, "$", "double")
        compared = _compare(op, near, F.lit(float(operand)))
        if isinstance(operand, int):  # whole numbers beyond 2^53 must not be compared as doubles
            compared = F.when(kind == "BIGINT", _compare(op, exact, F.lit(operand))).otherwise(compared)
        return kind.rlike(NUMBER_KINDS) & compared
    if isinstance(operand, str):
        return (kind == "STRING") & _compare(op, F.try_variant_get(value, "$", "string"), F.lit(operand))
    raise TypeError(f"cannot compare documents with {type(operand).__name__}")


def _elements(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _any_value(value: Column, test: Callable[[Column], Column]) -> Column:
    """Whether a test holds for a field, or for an element of the array it holds."""
    nested = F.exists(_elements(value), lambda x: F.coalesce(test(x), F.lit(False)))
    return F.coalesce(test(value), F.lit(False)) | F.coalesce(nested, F.lit(False))


def _holds(op: str, value: Column, operand: Any) -> Column:
    """Comparison with a field, or with an element of the array it holds."""
    found = _any_value(value, lambda x: _scalar(op, x, operand))
    if operand is None and op in ("$eq", "$gte", "$lte"):
        found = found | value.isNull()
    return found


Reach = Callable[[Callable[[Column], Column]], Column]


def _reached(value: Column, keys: list[str]) -> Reach:
    """Takes a test to the value at a path; below an array, to that of any element."""

    def holds(test: Callable[[Column], Column]) -> Column:
        if not keys:
            return test(value)
        key, rest = keys[0], keys[1:]
        inner = field(value, key)
        if key.isdigit():
            inner = F.coalesce(inner, F.try_variant_get(value, f"$[{key}]", "variant"))
        direct = _reached(inner, rest)(test)
        elements = F.try_variant_get(value, "$", "array<variant>")
        nested = F.exists(elements, lambda x: _reached(field(x, key), rest)(test))
        return F.when(elements.isNull() | inner.isNotNull(), direct).otherwise(F.coalesce(nested, F.lit(False)))

    return holds


def _in_document(doc: Column, path: str) -> Reach:
    """The same from the document down, which is an object and never an array."""
    first, *rest = path.split(".")
    return _reached(field(doc, first), rest)


def _in_column(column: Column) -> Reach:
    return lambda test: test(column)


def _test(op: str, reach: Reach, operand: Any, kind: T.DataType | None) -> Column:
    holds = _holds_typed(kind) if kind else _holds
    if op in ("$eq", "$gt", "$gte", "$lt", "$lte"):
        return reach(lambda v: holds(op, v, operand))
    if op == "$ne":
        return ~reach(lambda v: holds("$eq", v, operand))
    if op == "$in":
        return reach(lambda v: _any([holds("$eq", v, x) for x in operand]))
    if op == "$nin":
        return ~reach(lambda v: _any([holds("$eq", v, x) for x in operand]))
    if op == "$exists":
        there = reach(lambda v: v.isNotNull())
        return there if operand else ~there
    if op == "$not":
        return ~_field_tests(reach, operand, kind)
    if kind is None and op in ARRAY_TESTS:
        return reach(lambda v: F.coalesce(ARRAY_TESTS[op](v, operand), F.lit(False)))
    if kind is None and op in VALUE_TESTS:
        return reach(lambda v: _any_value(v, lambda x: VALUE_TESTS[op](x, operand)))
    raise ValueError(f"unknown filter operator {op}")


def _matches(value: Column, pattern: str) -> Column:
    return (F.schema_of_variant(value) == "STRING") & F.try_variant_get(value, "$", "string").rlike(pattern)


def _has_remainder(value: Column, operand: list[int]) -> Column:
    divisor, remainder = operand
    whole = F.try_variant_get(value, "$", "double").cast("bigint")
    return F.schema_of_variant(value).rlike(NUMBER_KINDS) & (whole % F.lit(divisor) == F.lit(remainder))


def _is_typed(value: Column, names: str | list[str]) -> Column:
    wanted = [names] if isinstance(names, str) else names
    unknown = [n for n in wanted if n not in TYPE_KINDS]
    if unknown:
        raise ValueError(f"unknown type {unknown[0]}")
    return _any([F.schema_of_variant(value).rlike(TYPE_KINDS[n]) for n in wanted])


def _element_matches(value: Column, condition: Mapping[str, Any]) -> Column:
    """Whether one element of an array meets all of a condition: tests on itself, or a filter on its fields."""
    if any(k.startswith("$") and k not in ("$and", "$or", "$nor") for k in condition):
        return F.exists(_elements(value), lambda x: _field_tests(_in_column(x), condition, None))
    return F.exists(_elements(value), lambda x: (F.schema_of_variant(x).startswith("OBJECT")) & compile_filter(condition, x))


ARRAY_TESTS: dict[str, Callable[[Column, Any], Column]] = {
    "$size": lambda v, n: F.size(_elements(v)) == F.lit(n),
    "$all": lambda v, wanted: _all([_holds("$eq", v, x) for x in wanted]) if wanted else F.lit(False),
    "$elemMatch": _element_matches,
}
VALUE_TESTS: dict[str, Callable[[Column, Any], Column]] = {"$regex": _matches, "$mod": _has_remainder, "$type": _is_typed}


def _is_of_kind(kind: T.DataType, operand: Any) -> bool:
    """Whether a column of this type holds values that can be compared with the operand."""
    if isinstance(operand, bool):
        return isinstance(kind, T.BooleanType)
    if isinstance(operand, (int, float)):
        return isinstance(kind, T.NumericType)
    if isinstance(operand, str):
        return isinstance(kind, T.StringType)
    raise TypeError(f"cannot compare documents with {type(operand).__name__}")


def _holds_typed(kind: T.DataType) -> Callable[[str, Column, Any], Column]:
    """The same on a column of its own, left bare so that it can reach the scan."""

    def holds(op: str, value: Column, operand: Any) -> Column:
        if operand is None:
            return value.isNull() if op in ("$eq", "$gte", "$lte") else F.lit(False)
        if not _is_of_kind(kind, operand):
            return F.lit(False)
        return value.isNotNull() & _compare(op, value, F.lit(operand))

    return holds


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests) if tests else F.lit(True)


def _field_tests(reach: Reach, condition: Any, kind: T.DataType | None) -> Column:
    if isinstance(condition, Mapping) and any(k.startswith("$") for k in condition):
        flags = condition.get("$options", "")
        tests = {op: f"(?{flags}){x}" if op == "$regex" and flags else x for op, x in condition.items() if op != "$options"}
        return _all([_test(op, reach, operand, kind) for op, operand in tests.items()])
    return _test("$eq", reach, condition, kind)


Columns = Mapping[str, tuple[Column, T.DataType]]


def compile_filter(query: Mapping[str, Any] | None, doc: Column, columns: Columns | None = None) -> Column:
    """Condition for a filter dict over a VARIANT document.

    ``columns`` names fields that the table also keeps as columns of their own, with their types; tests on them are
    pushed to the scan instead of being read from the document.
    """
    columns = columns or {}
    tests = []
    for key, condition in (query or {}).items():
        if key == "$and":
            tests.append(_all([compile_filter(q, doc, columns) for q in condition]))
        elif key == "$or":
            tests.append(_any([compile_filter(q, doc, columns) for q in condition]))
        elif key == "$nor":
            tests.append(~_any([compile_filter(q, doc, columns) for q in condition]))
        elif key.startswith("$"):
            raise ValueError(f"unknown filter operator {key}")
        elif key in columns:
            column, kind = columns[key]
            tests.append(_field_tests(_in_column(column), condition, kind))
        else:
            tests.append(_field_tests(_in_document(doc, key), condition, None))
    return _all(tests)


def comparable_columns(schema: T.StructType, above: tuple[str, ...] = ()) -> Columns:
    """Columns of a typed table, and fields of its structs by dotted path, that compare as their documents would."""
    found: dict[str, tuple[Column, T.DataType]] = {}
    for f in schema:
        here = (*above, f.name)
        if "." in f.name:
            continue
        if isinstance(f.dataType, T.StructType):
            found |= comparable_columns(f.dataType, here)
        elif isinstance(f.dataType, (T.StringType, T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType)):
            found[".".join(here)] = (F.col(".".join(f"`{key}`" for key in here)), f.dataType)
    return found


def _is_bare(query: Mapping[str, Any], columns: Columns) -> bool:
    """Whether columns alone can tell: comparisons on them, joined in any way."""

    def bare(key: str, condition: Any) -> bool:
        if key in ("$and", "$or", "$nor"):
            return all(_is_bare(q, columns) for q in condition)
        tests = condition if isinstance(condition, Mapping) else {"$eq": condition}
        return key in columns and set(tests) <= COMPARISONS and not any(isinstance(x, Mapping) for x in tests.values())

    return all(bare(k, c) for k, c in query.items())


def split_filter(query: Mapping[str, Any] | None, columns: Columns) -> tuple[Column | None, dict[str, Any]]:
    """A filter as a condition on columns, which a scan can take over, and the filter that is left for documents."""
    parts: list[dict[str, Any]] = []

    def flatten(some: Mapping[str, Any]) -> None:
        for key, condition in some.items():
            if key == "$and":
                for q in condition:
                    flatten(q)
            else:
                parts.append({key: condition})

    flatten(query or {})
    bare = [p for p in parts if _is_bare(p, columns)]
    rest = [p for p in parts if not _is_bare(p, columns)]
    condition = _all([compile_filter(p, F.lit(None), columns) for p in bare]) if bare else None
    return condition, {"$and": rest} if rest else {}


def fields_of(query: Mapping[str, Any] | None) -> set[str]:
    """Top-level fields a filter looks at."""
    found: set[str] = set()
    for key, condition in (query or {}).items():
        if key in ("$and", "$or", "$nor"):
            found = found.union(*[fields_of(q) for q in condition])
        else:
            found.add(key.split(".")[0])
    return found
