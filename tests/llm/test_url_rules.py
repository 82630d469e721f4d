import numpy as np

from moorage.llm import url_rules
from moorage.llm.queries import op7_url_filters
from moorage.llm.url_rules import ALLOW, BLOCK, Digests, digest_file, judge_urls


def judged(spark, rules, urls):
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    rows = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "id int, url string, host string")
    return {r.id: (r["host"], r["path"], r.rule, r.verdict) for r in judge_urls(rows, table, "url", ("id",)).collect()}


def test_longest_rule_wins(spark):
    rules = [("com", "/", ALLOW), ("a.com", "/en/", BLOCK), ("a.com", "/en/", BLOCK), ("w.a.com", "/en/", ALLOW), ("b.org", "", BLOCK)]
    urls = [
        "http://W.A.com/en/x?y#z",
        "http://x.a.com/en/",
        "http://xa.com/en/",
        "http://a.com/de",
        "http://a.com",
        "s://b.org?x",
        "nothing",
        None,
        "://",
        "http://b.org.net/",
        "http://É.com/" + "p" * 100_000,
    ]
    got = judged(spark, rules, urls)
    assert [got[i] for i in range(10)] == [
        ("w.a.com", "/en/x", "w.a.com/en/", ALLOW),
        ("x.a.com", "/en/", "a.com/en/", BLOCK),
        ("xa.com", "/en/", "com/", ALLOW),
        ("a.com", "/de", "com/", ALLOW),
        ("a.com", "", None, ALLOW),
        ("b.org", "", "b.org", BLOCK),
        ("", "", None, ALLOW),
        ("", "", None, ALLOW),
        ("", "", None, ALLOW),
        ("b.org.net", "/", None, ALLOW),
    ]
    assert got[10][0] == "É.com" and got[10][2:] == ("com/", ALLOW)


def test_no_rules_and_contradictions(spark):
    assert judged(spark, [], ["http://a.com/"])[0] == ("a.com", "/", None, ALLOW)
    assert judged(spark, [("a.com", "/", ALLOW), ("a.com", "/", BLOCK)], ["http://a.com/"])[0][3] == BLOCK


def test_many_files(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "RULES_PER_FILE", 3)
    rules = [(f"h{i}.org", "/", BLOCK) for i in range(20)]
    got = judged(spark, rules, [f"http://h{i}.org/" for i in range(30)])
    assert [got[i][3] for i in range(30)] == [BLOCK] * 20 + [ALLOW] * 10


def test_equal_digests_are_told_apart(monkeypatch):
    monkeypatch.setattr(url_rules, "_digest", lambda text: len(text))
    keys = ["a/", "b/", "cc/", "d/"]
    digests = Digests(np.frombuffer(digest_file(keys, [1, 1, 2, 1], [True, False, True, True]), "u1"))
    assert digests.probe(["b/", "d/", "e/", "cc/", "dd/"]) == {"b/": ALLOW, "d/": BLOCK, "cc/": BLOCK}


def test_query_handles_nulls(spark, stored):
    folder = stored(pages=([(1, None, None), (1, None, None), (None, "http://x.net/fr/", "")], "page_id bigint, url string, html string"))
    rows = sorted((tuple(r) for r in op7_url_filters(spark, folder).collect()), key=repr)
    assert rows == sorted([(1, "", "", None, ALLOW)] * 2 + [(None, "x.net", "/fr/", "net/fr/", BLOCK)], key=repr)
