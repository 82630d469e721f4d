import zlib

import numpy as np
import pyarrow as pa
import pytest

from moorage.llm import quality
from moorage.llm.queries import op11_quality
from moorage.llm.quality import fitted, learn, score, shares, singular_space, term_counts, term_weights, unit, voted
from tests.llm.conftest import SMALL

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def kinds_by_hand(text):
    return [quality.kind_of(ord(c)) for c in text]


def brute_terms(text):
    kinds = kinds_by_hand(text)
    runs = []
    for kind in kinds:
        if runs and runs[-1][0] == kind:
            runs[-1][1] += 1
        else:
            runs.append([kind, 1])
    coded = [0, *([k * 4 + min(n, 3) for k, n in runs] or [0]), 0]
    counts = np.zeros(quality.TERMS, np.int64)
    for three in zip(coded, coded[1:], coded[2:], strict=False):
        counts[int(quality.mixed(*[np.array([v]) for v in three])[0] % quality.SHAPE_BUCKETS)] += 1
    words, word = [], ""
    for c, kind in zip(text + " ", [*kinds, quality.SPACE], strict=True):
        if kind in (quality.SPACE, quality.LINE):
            words += [word] if word else []
            word = ""
        else:
            word += c
    for i, w in enumerate(words):
        lag = next((b for b in range(1, quality.LAGS + 1) if i >= b and words[i - b] == w), 0)
        values = (lag + 1, min(len(w), 24), kinds_by_hand(w)[0], kinds_by_hand(w)[-1])
        counts[quality.SHAPE_BUCKETS + int(quality.mixed(*[np.array([v]) for v in values])[0] % quality.WORD_BUCKETS)] += 1
    return counts


@pytest.mark.parametrize("text", ["", " ", "a", "The the The!! the", "A | b | cé\n\nÉ漢 $$$ 12 a b a b a", " x\t\ty ", "😀 😀 😀"])
def test_terms_against_brute_force(text):
    assert np.array_equal(term_counts(text.encode()), brute_terms(text))


def test_pieces_of_long_texts_lose_no_word(monkeypatch):
    text = ("abc de. " * 500).encode()
    whole = term_counts(text)
    monkeypatch.setattr(quality, "CHARS", 100)
    cut = term_counts(text)
    assert cut[quality.SHAPE_BUCKETS :].sum() == whole[quality.SHAPE_BUCKETS :].sum() == 1000


def test_space_equals_the_full_decomposition():
    draw = np.random.default_rng(3)
    matrix = draw.standard_normal((60, 8)) @ draw.standard_normal((8, 90)) + 0.01 * draw.standard_normal((60, 90))
    space = singular_space(matrix, 8)
    right = np.linalg.svd(matrix)[2][:8].T
    assert np.allclose(space @ space.T, right @ right.T, atol=1e-3)


def model_of(texts, labels):
    rows = shares(pa.array(texts))
    counts = np.append(np.count_nonzero(rows, axis=0), len(texts))
    labels = np.array(labels)
    return rows, counts, fitted(counts, rows, labels, {k: int((labels == k).sum()) for k in set(labels.tolist())})


def test_votes_against_brute_force(monkeypatch):
    monkeypatch.setattr(quality, "NEIGHBOURS", 3)
    texts = ["a b c.", "A!! B!!", "x x x x", "The end. So.", "a b c.", "Q$$$ r$$$", "a b c.", ""]
    labels = [1, 0, 0, 1, 1, 0, 0, 1]
    rows, counts, model = model_of(texts, labels)
    found = voted(rows, model)
    weighted = unit(unit(rows * term_weights(counts)) @ model.space)
    for i in range(len(texts)):
        near = sorted(((round(float(max(0, weighted[i] @ v)), 5), int(labels[j]), model.votes[j]) for j, v in enumerate(model.vectors)), reverse=True)
        last = near[2][0]
        votes = [(c**quality.SHARPNESS * w, one) for c, one, w in near if c >= last]
        top = sum(w for w, one in votes if one) + quality.PRIOR_VOTES * model.prior
        assert found[i] == pytest.approx(top / (sum(w for w, _ in votes) + quality.PRIOR_VOTES), abs=2e-4)
    assert found[0] == found[4] == found[6]


def test_held_out_labels_are_told(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = op11_quality(spark, SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    right = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert len(right) >= 10 and sum(right) / len(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == held(r.doc_id) for r in rows)


def test_held_out_labels_teach_nothing_and_ids_say_nothing(spark, stored, tmp_path):
    words = ["Good text here. ", "BAD!! TEXT!! ", "word word word "]
    docs = [(i, words[i % 3] * (1 + i % 4), "en", "s", 1) for i in range(90)]
    docs += [(None, "Good text here. ", None, None, None), (500, None, None, None, None), (501, "", None, None, None), (3, "Good text here. ", None, None, None)]
    labels = [(i, int(i % 3 == 0), 0) for i in range(90)] + [(None, 1, 0), (4, None, 0), (5, 7, 0), (777, 1, 0), (0, 1, 0)]
    one = stored(documents=(docs, DOCS), labels=(labels, LABELS))
    first = sorted(map(tuple, op11_quality(spark, one).select("doc_id", "held_out", "score", "predicted").collect()), key=repr)
    other = str(tmp_path / "other")
    spark.createDataFrame(docs, DOCS).write.parquet(f"{other}/documents.parquet")
    turned = [(i, 1 - q if held(i) and q in (0, 1) else q, t) for i, q, t in labels]
    spark.createDataFrame(turned, LABELS).write.parquet(f"{other}/labels.parquet")
    assert first == sorted(map(tuple, op11_quality(spark, other).select("doc_id", "held_out", "score", "predicted").collect()), key=repr)
    by_id = {r[0]: r for r in first}
    assert by_id[1][2] < 0.3 < by_id[0][2] and by_id[2][3] == 0 and by_id[None][3] == 1
    assert by_id[500][2] == by_id[501][2] and len(first) == len(docs)


def test_sample_is_bounded_and_stands_for_all(spark):
    docs = spark.createDataFrame([(i, f"Text {i}." if i % 4 else "NO!! NO!!") for i in range(200)], "doc_id int, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(200)], "doc_id int, quality int")
    model = learn(docs, docs, labels, bound=20)
    assert len(model.labels) == 20 and model.labels.sum() == 10 and model.prior == 0.75
    assert model.votes[model.labels == 1][0] == pytest.approx(3 * model.votes[model.labels == 0][0])


def test_nothing_learned_gives_an_even_score(spark):
    docs = spark.createDataFrame([(1, "abc", "x"), (2, None, "y")], "doc_id int, text string, score string")
    assert learn(docs, docs, spark.createDataFrame([], "doc_id int, quality int")) is None
    assert sorted(map(tuple, score(docs, None).collect())) == [(1, 0.5, 1), (2, 0.5, 1)]
