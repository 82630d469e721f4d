import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from moorage.functions import documents as D


def each(spark, values, column, schema="x string"):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{schema}, i int")
    return [r[0] for r in df.select(column.alias("y"), "i").orderBy("i").collect()]


def projected(spark, doc, paths):
    (text,) = each(spark, [json.dumps(doc)], F.to_json(D.project_paths(F.parse_json("x"), paths)))
    return json.loads(text)


BAD = [
    '{"a":1} x', '{"a":1}]', '{"a":1}}', "[1,2", '{"a":1', "", " ", "1,2", '1,"e":2', "NaN", "{'a':1}", '{"a":1,"a":2}',
    '{"a":01}', "nul", '"open', '{"a":1},', '],[', '{"a":[1,]}', '{"a":1}//', "\x01",
]
GOOD = ['{"a":1}', "[1,2]", "null", "true", "0", "-1.5e3", '"x"', ' {"a": [1, {"b": null}]} ', "{}", "[]", '"\\u00e9"']


def test_strict_json_takes_one_complete_value(spark):
    assert each(spark, BAD, D.strict_json(F.col("x")).isNull()) == [True] * len(BAD)
    assert each(spark, GOOD, D.strict_json(F.col("x")).isNull()) == [False] * len(GOOD)
    assert each(spark, [None], D.strict_json(F.col("x")).isNull()) == [True]


def test_strict_json_is_not_fooled_by_its_own_frame(spark):
    values = ['1,7],[2', '1],"x":[2', '{"a":1},5],[6']
    assert each(spark, values, D.strict_json(F.col("x")).isNull()) == [True] * 3


def test_hash_ignores_key_order_and_spacing(spark):
    a, b, c = each(
        spark, ['{"b":[1,{"d":1,"c":2}],"a":"é"}', '{ "a":"é","b":[1,{"c":2,"d":1}] }', '{"a":"é","b":[{"c":2,"d":1},1]}'],
        D.document_hash(F.parse_json("x")),
    )
    assert a == b != c


def test_document_id(spark):
    docs = ['{"_id":"a"}', '{"_id":12}', '{"_id":{"$oid":"ff"}}', '{"_id":null}', '{"x":1}', '{"_id":{"k":1}}']
    assert each(spark, docs, D.document_id(F.parse_json("x"))) == ["a", "12", "ff", None, None, '{"k":1}']


def test_stringify_id(spark):
    docs = ['{"_id":"a","x":"007"}', '{"_id":12,"x":[1]}', '{"_id":{"$oid":"ff"}}', '{"_id":null}', '{"x":1}']
    got = [json.loads(t) for t in each(spark, docs, F.to_json(D.stringify_id(F.parse_json("x"))))]
    assert got == [{"_id": "a", "x": "007"}, {"_id": "12", "x": [1]}, {"_id": "ff"}, {"_id": None}, {"x": 1}]


DOC = {"_id": 1, "a": {"b": 1, "c": None, "d": {"e": 2, "f": None}}, "n": None, "arr": [{"x": 1}], "s": '{"j":1}'}


@pytest.mark.parametrize(
    "paths, expected",
    [
        ([], DOC),
        (None, DOC),
        (["n", "zz"], {"_id": 1, "n": None}),
        (["a.b", "a.c"], {"_id": 1, "a": {"b": 1}}),
        (["a.c"], {"_id": 1}),
        (["a.d.e", "a.d.f", "a.b"], {"_id": 1, "a": {"b": 1, "d": {"e": 2}}}),
        (["a.d", "a.d.e"], {"_id": 1, "a": {"d": {"e": 2, "f": None}}}),
        (["a.d.e", "a.d"], {"_id": 1, "a": {"d": {"e": 2, "f": None}}}),
        (["a.b", "a"], {"_id": 1, "a": DOC["a"]}),
        (["arr.x"], {"_id": 1}),
        (["arr", "s"], {"_id": 1, "arr": [{"x": 1}], "s": '{"j":1}'}),
        (["a.b.zz"], {"_id": 1}),
    ],
)
def test_project_paths(spark, paths, expected):
    assert projected(spark, DOC, paths) == expected


def test_project_paths_without_id_or_object(spark):
    assert projected(spark, {"x": 1}, ["x"]) == {"x": 1}
    assert projected(spark, {"_id": None}, ["x"]) == {"_id": None}


leaf = st.one_of(st.none(), st.booleans(), st.integers(-5, 5), st.text("ab", max_size=2))
tree = st.recursive(leaf, lambda t: st.one_of(st.dictionaries(st.sampled_from("abc"), t, max_size=3), st.lists(t, max_size=2)))
path = st.lists(st.sampled_from("abc"), min_size=1, max_size=3).map(".".join)


def expected_projection(doc, paths):
    """The rules in plain words: whole fields first, then leaves that are reached and not null."""
    out = {}
    for p in paths:
        if "." not in p and p in doc:
            out[p] = doc[p]
    whole = set(out)
    leaves = {}
    for p in paths:
        keys = p.split(".")
        value = doc
        for k in keys:
            value = value.get(k) if isinstance(value, dict) else None
        if len(keys) > 1 and value is not None and keys[0] not in whole:
            leaves[p] = value
    for p in sorted(leaves, key=lambda p: -p.count(".")):  # shorter paths last: they hold the longer ones
        node = out
        *above, last = p.split(".")
        for k in above:
            node = node.setdefault(k, {})
        node[last] = leaves[p]
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(docs=st.lists(st.dictionaries(st.sampled_from("abc"), tree, max_size=3), min_size=5, max_size=30), paths=st.lists(path, min_size=1, max_size=4, unique=True))
def test_project_paths_on_any_documents(spark, docs, paths):
    got = each(spark, [json.dumps(d) for d in docs], F.to_json(D.project_paths(F.parse_json("x"), paths)))
    assert [json.loads(t) for t in got] == [expected_projection(d, paths) for d in docs]


def test_set_fields(spark):
    values = {"n": F.lit(1).cast("variant"), "a.b": F.lit("x").cast("variant"), "z.y": F.lit(None).cast("variant")}
    docs = ['{"k":0}', '{"n":9,"a":{"c":1}}', '{"a":5}']
    got = [json.loads(t) for t in each(spark, docs, F.to_json(D.set_fields(F.parse_json("x"), values)))]
    assert got == [{"k": 0, "n": 1, "a": {"b": "x"}}, {"n": 1, "a": {"c": 1, "b": "x"}}, {"n": 1, "a": {"b": "x"}}]
    with pytest.raises(ValueError):
        D.set_fields(F.col("x"), {"a": F.lit(1), "a.b": F.lit(1)})


def test_typed_columns_become_text_where_json_has_no_type(spark):
    df = spark.sql(
        """SELECT 1 AS i, 1.5D AS d, CAST(2.50 AS DECIMAL(9,2)) AS dec, DATE'2025-01-02' AS day, true AS b, 'x' AS s,
           array(DATE'2025-01-02') AS days, named_struct('t', TIMESTAMP_NTZ'2025-01-02 03:04:05') AS st,
           map('k', CAST(1 AS DECIMAL(3,1))) AS m, CAST(NULL AS STRUCT<q: DATE>) AS none"""
    )
    got = json.loads(df.select(F.to_json(D.document_of(df.schema))).first()[0])
    assert got == {
        "i": 1, "d": 1.5, "dec": "2.50", "day": "2025-01-02", "b": True, "s": "x", "days": ["2025-01-02"],
        "st": {"t": "2025-01-02 03:04:05"}, "m": {"k": "1.0"}, "none": None,
    }
