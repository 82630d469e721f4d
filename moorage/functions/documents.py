"""Expressions on schemaless documents held as VARIANT."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, functions as F, types as T


def variant_path(*keys: str) -> str:
    """Variant path that takes every key literally."""
    path = "$"
    for key in keys:
        if "'" in key and '"' in key:
            raise ValueError(f"field name mixes both kinds of quotes: {key!r}")
        quote = '"' if "'" in key else "'"
        path += f"[{quote}{key}{quote}]"
    return path


def field(doc: Column, *keys: str) -> Column:
    """Field of a document as VARIANT: SQL NULL if missing, a variant null if it is null.

    Only objects are entered; a path through an array finds nothing.
    """
    return F.try_variant_get(doc, variant_path(*keys), "variant")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` for a value that is used several times but should be computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strict_json(text: Column) -> Column:
    """The VARIANT of a text that is one JSON value, else NULL.

    ``try_parse_json`` ignores whatever follows the first value. Here the text is parsed once, as the
    first of two array elements; the second is its own hash, which is found in its place only if the
    text was exactly one complete value. Repeated object keys and NaN are rejected by the parser.
    """
    mark = F.xxhash64(text)
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]")))

    def first(parsed: Column) -> Column:
        whole = F.try_variant_get(parsed, "$[1]", "bigint") == mark
        return F.when(whole, F.try_variant_get(parsed, "$[0]", "variant"))

    return once(pair, first)


def is_object_text(text: Column) -> Column:
    """Whether a valid JSON text is an object; cheaper than asking the parsed value."""
    return F.ltrim(text, F.lit(" \t\r\n")).startswith("{")


def canonical_json(doc: Column) -> Column:
    """Compact JSON text; variants keep object keys sorted, so key order does not show."""
    return F.to_json(doc)


def document_hash(doc: Column) -> Column:
    return F.md5(canonical_json(doc))


def document_id(doc: Column) -> Column:
    """``_id`` as text, looking into ``{"$oid": ...}`` first; NULL if missing or null."""
    return F.coalesce(
        F.try_variant_get(doc, variant_path("_id", "$oid"), "string"),
        F.try_variant_get(doc, variant_path("_id"), "string"),
    )


def as_variant(value: Column) -> Column:
    return value.cast(T.VariantType())


def object_entries(doc: Column) -> Column:
    """Top-level fields as MAP<STRING, VARIANT>; NULL if the document is not an object."""
    return F.try_variant_get(doc, "$", "map<string,variant>")


def stringify_id(doc: Column) -> Column:
    """Document whose ``_id``, if it has a usable one, is text."""
    others = F.map_filter(object_entries(doc), lambda k, _: k != "_id")
    rebuilt = F.to_variant_object(F.map_concat(others, F.create_map(F.lit("_id"), as_variant(document_id(doc)))))
    return F.when(_needs_no_text(field(doc, "_id")), doc).otherwise(rebuilt)


def _needs_no_text(raw_id: Column) -> Column:
    return raw_id.isNull() | F.is_variant_null(raw_id) | (F.schema_of_variant(raw_id) == "STRING")


def text_id(doc: Column) -> Column:
    """The ``_id`` of a document as it is stored: text, if it has a usable one."""
    as_text = as_variant(document_id(doc))
    return once(field(doc, "_id"), lambda raw: F.when(_needs_no_text(raw), raw).otherwise(as_text))


def _tree(paths: Iterable[str]) -> dict:
    """Dotted paths as nested dicts; ``None`` marks a field wanted whole, which covers all below it."""
    root: dict = {}
    for path in paths:
        node, keys = root, path.split(".")
        for i, key in enumerate(keys):
            if key in node and node[key] is None:
                break
            if i == len(keys) - 1:
                node[key] = None
            else:
                node = node.setdefault(key, {})
    return root


def _kept(doc: Column, at: tuple[str, ...], node: dict, replaced: Mapping[str, Column] | None = None) -> Column:
    pairs: list[Column] = []
    for key, below in node.items():
        here = (*at, key)
        if below is None:
            value = replaced[key] if replaced and key in replaced else field(doc, *here)
            if at:  # a null below the top level counts as missing
                value = once(value, lambda v: F.when(~F.is_variant_null(v), v))
        else:
            value = once(_kept(doc, here, below), lambda m: F.when(F.size(m) > 0, F.to_variant_object(m)))
        pairs += [F.lit(key), value]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def project_paths(doc: Column, paths: Iterable[str] | None, id_as_text: bool = False) -> Column:
    """Document with only the given dotted paths, and ``_id``, which is made text on request.

    Top-level fields stay even when null, deeper ones only when not null. A field asked for whole wins
    over paths below it. No paths means the whole document.
    """
    paths = list(paths or [])
    if not paths:
        return stringify_id(doc) if id_as_text else doc
    replaced = {"_id": text_id(doc)} if id_as_text else {}
    return F.to_variant_object(_kept(doc, (), _tree([*paths, "_id"]), replaced))


def set_fields(doc: Column, values: Mapping[str, Column]) -> Column:
    """Document with fields at dotted paths set; a NULL value leaves its field alone."""
    tree: dict = {}
    for path, value in values.items():
        node, keys = tree, path.split(".")
        for key in keys[:-1]:
            node = node.setdefault(key, {})
            if not isinstance(node, dict):
                raise ValueError(f"{path!r} lies below another field that is set")
        if keys[-1] in node:
            raise ValueError(f"{path!r} is set twice, or lies above another field that is set")
        node[keys[-1]] = value
    return _with_values(doc, tree)


def _with_values(doc: Column, node: dict) -> Column:
    pairs: list[Column] = []
    for key, value in node.items():
        if isinstance(value, dict):
            value = _with_values(field(doc, key), value)
        pairs += [F.lit(key), value]
    nothing = F.create_map().cast("map<string,variant>")
    entries = F.coalesce(object_entries(doc), nothing)

    def laid_over(new: Column) -> Column:
        old = F.map_filter(entries, lambda k, _: ~F.map_contains_key(new, k))
        return F.when(F.size(new) > 0, F.to_variant_object(F.map_concat(old, new))).otherwise(doc)

    return once(F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()), laid_over)


def json_ready(value: Column, kind: T.DataType) -> Column:
    """Typed column with every value JSON has no type for turned into text, at any depth."""
    if isinstance(kind, (T.StringType, T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType, T.VariantType)):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: json_ready(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(
            F.transform_keys(value, lambda k, _: k.cast("string")), lambda _, v: json_ready(v, kind.valueType)
        )
    if isinstance(kind, T.StructType):
        inner = F.struct(*[json_ready(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), inner)
    return value.cast("string")


def document_of(schema: T.StructType) -> Column:
    """All columns of a typed table as one document."""
    return F.to_variant_object(F.struct(*[json_ready(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema]))
