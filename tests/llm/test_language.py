import math
import zlib
from collections import Counter

import numpy as np
import pytest

from moorage.llm import language
from moorage.llm.language import buckets_of, identify, learn, predicted
from moorage.llm.queries import op3_language
from tests.llm.conftest import SMALL


def brute_model(rows):
    counts = {}
    for text, lang in rows:
        held = counts.setdefault(lang, Counter())
        padded = f" {text} ".lower() if text else "  "
        for size in language.SIZES:
            for i in range(len(padded) - size + 1):
                gram = np.frombuffer(padded[i : i + size].encode("utf-32-le"), np.uint32)
                held[int(language.hashed(gram, size)[0])] += 1
    return counts


def test_learning_and_scoring_against_brute_force(spark):
    rows = [("Ab é", "x"), ("ba b", "y"), ("", "y"), (None, "y"), ("zz", None), ("Ab é", "x")]
    langs, matrix = learn(spark.createDataFrame(rows, "text string, lang string"))
    counts = brute_model([(t, k) for t, k in rows if t is not None and k])
    assert langs == ["x", "y"]
    totals = []
    for k, lang in enumerate(langs):
        total = sum(counts[lang].values()) + language.SMOOTHING * language.BUCKETS
        expected = np.full(language.BUCKETS, math.log(language.SMOOTHING / total))
        for bucket, n in counts[lang].items():
            expected[bucket] = math.log((n + language.SMOOTHING) / total)
        assert np.allclose(matrix[k], expected, atol=1e-5)
        totals.append(sum(expected[b] * n for b, n in brute_model([("ab", "q")])["q"].items()))
    found, scores = predicted(["ab", None, "12 .", "", "ab"], langs, matrix)
    assert found == ["xy"[int(np.argmax(totals))], "und", "und", "und", found[0]]
    assert scores[0] == pytest.approx(1 / (1 + math.exp(-abs(totals[0] - totals[1]))), rel=1e-3)
    assert scores[1:4] == [0.0] * 3 and scores[4] == scores[0]


def test_pieces_of_long_texts_hold_every_ngram_once(monkeypatch):
    text = "Wörter und más palabras " * 30
    whole = np.sort(np.concatenate(list(buckets_of(text))))
    monkeypatch.setattr(language, "CHARS", 17)
    assert np.array_equal(whole, np.sort(np.concatenate(list(buckets_of(text)))))


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op3_language(spark, SMALL).collect()
    assert len(rows) == len(docs) and sorted(rows) == sorted(op3_language(spark, SMALL).collect())
    right = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        if r.held_out and docs[r.doc_id].lang:
            right.append(r.lang_pred == docs[r.doc_id].lang)
    assert sum(right) / len(right) > 0.95


def test_only_other_folds_teach(spark, stored):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(i, "uvw uvw" if i in held else "abc abc", "held" if i in held else "taught", "s", 1) for i in range(60)]
    rows += [(None, "uvw", "held", "s", 1), (99, None, "taught", None, None), (100, "abc", None, "s", 1)]
    folder = stored(documents=(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    found = op3_language(spark, folder).collect()
    assert {r.lang_pred for r in found if r.doc_id != 99} == {"taught"} and len(found) == len(rows)


def test_nothing_learned_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "abc", "x")], "score int, text string, lang_pred string")
    assert [tuple(r) for r in identify(docs, ([], np.zeros((0, language.BUCKETS))), keep=()).collect()] == [("und", 0.0)]
