import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from moorage.llm import fill_middle
from moorage.llm.fill_middle import BOUND, fill_in_middle, rank_index, raw_bytes, restored
from moorage.llm.queries import op12_fill_in_middle
from pyspark.sql import functions as F

ALPHABETS = ["abc d.", "aé", "é漢😀a", "😀", "x" * 50 + "漢", "<PSM>ab"]


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h4 % 100 < 20:
        return n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts():
    draw = random.Random(5)
    made = ["", None, "a", "<", "<P>", "x<S>y", "<<M", "é", "😀😀", "a" * 300_000, "é" * 1000 + "a" * 1000 + "漢" * 1000]
    for _ in range(300):
        made.append("".join(draw.choices(draw.choice(ALPHABETS), k=draw.randrange(400))))
    made.append("".join(draw.choices("aé漢😀", k=50_000)))
    return made


def test_operator_against_brute_force(spark):
    rows = [(i, t, "kept") for i, t in enumerate(texts())] + [(None, "no id"), (3, "twice"), (3, "twice")]
    rows = [(*r, "kept") if len(r) == 2 else r for r in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `form` string")
    found = fill_in_middle(docs.withColumnRenamed("form", "odd name:"), keep=("doc_id", "odd name:"))
    found = found.withColumn("again", restored(F.col("output"), F.col("form")))
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    wanted = sorted(((i, "kept", *brute(i, t), t or "") for i, t, _ in rows), key=repr)
    assert got == wanted


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_index_is_exact_and_bounded(alphabet):
    draw = random.Random(1)
    text = "".join(draw.choices(alphabet, k=30_000)).encode()
    offsets = np.append(np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80), len(text))
    index = rank_index(offsets)
    assert np.array_equal(index.offsets(np.arange(len(offsets))), offsets)
    assert np.abs(index.residuals).max() <= BOUND and len(index.starts) < len(offsets) / 20


def test_one_line_for_texts_of_one_byte_and_several_for_changing_ones(monkeypatch):
    assert len(rank_index(np.arange(1_000_000)).starts) == 1
    steps = np.concatenate([np.full(5000, 1), np.full(5000, 4)] * 3)
    offsets = np.cumsum(steps)
    few = rank_index(offsets)
    assert 6 <= len(few.starts) <= 12 and np.array_equal(few.offsets(np.arange(len(offsets))), offsets)
    monkeypatch.setattr(fill_middle, "BOUND", 2)
    many = rank_index(offsets)
    assert len(many.starts) >= len(few.starts) and np.array_equal(many.offsets(np.arange(len(offsets))), offsets)


def test_index_of_nothing():
    assert rank_index(np.array([0])).offsets(np.array([0])).tolist() == [0]
    assert raw_bytes(pa.array([None, ""], pa.string()))[1].tolist() == [0, 0, 0]


def test_sliced_batches_and_large_batches_agree(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "aé" * i) for i in range(200)], "doc_id bigint, text string")
    whole = sorted(map(tuple, fill_in_middle(docs, keep=("doc_id",)).collect()))
    batch = pa.RecordBatch.from_pydict({f"h{i}": [7] * 5 for i in (1, 2, 3, 4)} | {"text": ["ab", "é", None, "漢字", ""]}).slice(1, 3)
    assert fill_middle.assembled(batch)[0].to_pylist() == [1, 0, 2]
    assert whole == sorted((i, *brute(i, "aé" * i)) for i in range(200))


def test_query_restores_every_text(spark, stored):
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts())]
    folder = stored(documents=(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    for r in op12_fill_in_middle(spark, folder).collect():
        text = rows[r.doc_id][1] or ""
        n, form, prefix, middle, output = brute(r.doc_id, text)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()
