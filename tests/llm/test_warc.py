import gzip
import hashlib
import random
from pathlib import Path

from moorage.llm import warc
from moorage.llm.queries import op2_warc
from moorage.llm.warc import LoserTree, capture_index, records, run_of, url_key, write_archives

SCHEMA = "page_id bigint, url string, html string, record_type string"


def test_loser_tree_merges():
    rng = random.Random(2)
    for count in (0, 1, 2, 3, 7, 20):
        sequences = [sorted(rng.choices(range(30), k=rng.randint(0, 9))) for _ in range(count)]
        out = [(sequences[n][p], n, p) for n, p in LoserTree(sequences)]
        assert out == sorted((key, n, p) for n, s in enumerate(sequences) for p, key in enumerate(s))


def test_responses_and_revisits(spark, stored):
    long, other = "é" * 50, "WARC/1.0\r\n\r\n\r\nContent-Length: 5\r\n" + "x" * 200
    rows = [
        (5, "http://A.b/x\r\ny", long, "q"),
        (3, "http://A.b/", long, ""),
        (4, None, long, ""),
        (None, "http://c.b/", long, ""),
        (7, "", other, ""),
        (8, "u", other, ""),
        (8, "u", other, ""),
        (9, "u", None, ""),
        (10, "u", "", ""),
        (11, "u", "s" * 99, ""),
        (12, "u", "s" * 99, ""),
        (-9223372036854775808, "z", "y" * 300_000, ""),
    ]
    got = op2_warc(spark, stored(pages=(rows, SCHEMA))).collect()
    expected = []
    for i, _, html, _ in rows:
        payload = (html or "").encode()
        first = min((j for j, _, h, _ in rows if (h or "").encode() == payload and j is not None), default=None)
        revisit = len(payload) >= 100 and i != first
        digest = hashlib.sha256(payload).hexdigest()
        expected.append((i, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_histories_are_in_order_across_many_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 7)
    monkeypatch.setattr(warc, "RANGE_CAPTURES", 30)
    rows = spark.sql("""
        SELECT id AS record_id, concat('http://h', id % 3, '.org/', id % 5) AS url,
               timestamp_seconds(1000 - id) AS captured, concat('text ', id) AS payload
        FROM range(0, 200, 1, 4)""")
    folder = write_archives(rows)
    index = [(r.url_key, r.captured) for r in capture_index(spark, folder).collect()]
    assert len(index) == 200 and index == sorted(index)
    files = [f for f in Path(folder.removeprefix("file:")).glob("part-*")]
    assert len(files) >= 28
    for file in files:
        found = list(records(file.read_bytes()))
        text = gzip.decompress(file.read_bytes())
        assert all(text[position:].startswith(b"WARC/1.0\r\n") for position, _, _ in found)
        keys = [warc._place(r) for r in run_of(str(file), file.read_bytes())]
        assert keys == sorted(keys)


def test_url_keys():
    assert url_key("https://www.Example.com/A?b") == "com,example,www)/A?b"
    assert url_key("x") == "x"
