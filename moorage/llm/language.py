"""Language identification: multinomial naive Bayes over hashed character n-grams.

Learning counts n-grams of all labelled texts in each task and sums the counts by language and bucket; what comes to
the driver are at most ``BUCKETS`` counts per language, whatever the number of texts. The matrix of log-probabilities
is broadcast. Scoring hashes the n-grams of a batch of texts with numpy and adds up their rows of the matrix.

N-grams run over code points in lower case, with a space before and after the text. The score is the posterior
probability of the language, with even priors: the share of languages in what is learned says nothing about a text.

A null text or one without a letter is ``und`` with score 0, as is every text if nothing was learned. Languages that
tie go to the smaller name. Rows without language or with an empty table teach nothing. Texts of any length count
whole; they are taken in pieces of ``CHARS`` characters, so memory is bounded. Repeated rows each get their result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from moorage.llm.common import forget_models, lean, small_batches

BUCKETS = 1 << 16
SIZES = (1, 2, 3)
CHARS = 1 << 20
SMOOTHING = 0.5
UNDETERMINED = "und"

LETTER = re.compile(r"[^\W\d_]")


def hashed(points: np.ndarray, size: int) -> np.ndarray:
    """Buckets of the n-grams of ``size`` code points."""
    value = np.full(len(points) - size + 1, size, np.uint32)
    for i in range(size):
        value = (value ^ points[i : len(points) - size + 1 + i]) * np.uint32(0x9E3779B1)
        value ^= value >> np.uint32(15)
    return value & np.uint32(BUCKETS - 1)


def stretches(text: str) -> Iterator[np.ndarray]:
    """Code points of the text in lower case between spaces, in pieces that overlap by the longest n-gram less one."""
    step = CHARS - max(SIZES) + 1
    for start in range(0, max(1, len(text)), step):
        piece = text[start : start + CHARS].lower()
        if start == 0:
            piece = " " + piece
        last = start + CHARS >= len(text)
        yield np.frombuffer((piece + " " if last else piece).encode("utf-32-le", "replace"), np.uint32)
        if last:
            break


def own_part(size: int, points: np.ndarray, first: bool) -> np.ndarray:
    """N-grams of a piece, without those that the piece before has held."""
    skip = 0 if first else max(SIZES) - size
    return hashed(points[skip:], size) if len(points) - skip >= size else np.empty(0, np.uint32)


def buckets_of(text: str) -> Iterator[np.ndarray]:
    for number, points in enumerate(stretches(text)):
        for size in SIZES:
            yield own_part(size, points, number == 0)


def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language and bucket of all texts of a task."""
    forget_models()
    counts: dict[str, np.ndarray] = {}
    waiting: dict[str, list[np.ndarray]] = {}
    size = 0

    def add() -> None:
        for lang, parts in waiting.items():
            held = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            held += np.bincount(np.concatenate(parts), minlength=BUCKETS)
        waiting.clear()

    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
            for buckets in buckets_of(text.as_py()):
                waiting.setdefault(lang, []).append(buckets)
                size += len(buckets)
                if size >= CHARS:
                    add()
                    size = 0
    add()
    for lang, held in counts.items():
        used = np.flatnonzero(held)
        columns = [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(held[used], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and log-probabilities by language and bucket."""
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = labelled.mapInArrow(lean(counted), "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = counts.toArrow()
    names = rows.column("lang").to_pylist()
    langs = sorted(set(names))
    place = {name: i for i, name in enumerate(langs)}
    matrix = np.full((len(langs), BUCKETS), SMOOTHING)
    matrix[[place[n] for n in names], rows.column("bucket").to_numpy()] += rows.column("n").to_numpy()
    return langs, np.log(matrix / matrix.sum(axis=1, keepdims=True)).astype(np.float32)


def scored(texts: list[str], matrix: np.ndarray) -> np.ndarray:
    """Log-likelihood of each text by language: rows of the matrix at the n-grams of all texts, added up by text."""
    totals = np.zeros((len(texts), len(matrix)))
    buckets: list[np.ndarray] = []
    owners: list[int] = []
    held = 0

    def add() -> None:
        starts = np.cumsum([0, *[len(b) for b in buckets[:-1]]])
        together = np.concatenate(buckets)
        for k, row in enumerate(matrix):
            np.add.at(totals[:, k], owners, np.add.reduceat(row[together], starts, dtype=np.float64))

    for i, text in enumerate(texts):
        for part in buckets_of(text):
            if len(part):
                buckets.append(part)
                owners.append(i)
                held += len(part)
        if held >= CHARS:
            add()
            buckets, owners, held = [], [], 0
    if buckets:
        add()
    return totals


def predicted(texts: list[str | None], langs: list[str], matrix: np.ndarray) -> tuple[list[str], list[float]]:
    found, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    open_ones = [i for i, t in enumerate(texts) if langs and t and LETTER.search(t)]
    totals = scored([texts[i] for i in open_ones], matrix)
    best = totals.argmax(axis=1) if len(open_ones) else []
    for i, row, k in zip(open_ones, totals, best, strict=True):
        found[i] = langs[k]
        scores[i] = float(1 / np.exp(np.minimum(row - row[k], 0)).sum())
    return found, scores


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``keep`` of each row, with lang_pred and score of its text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)], F.col(text).alias("text"))
    kept = "".join(f"kept_{i} {rows.schema[f'kept_{i}'].dataType.simpleString()}, " for i in range(len(keep)))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_models()
        langs, matrix = sent.value
        for batch in small_batches(batches, "text"):
            found, scores = predicted(batch.column("text").to_pylist(), langs, matrix)
            rest = batch.drop_columns(["text"])
            columns = [*rest.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest.schema.names, "lang_pred", "score"])

    out = rows.mapInArrow(lean(score), kept + "lang_pred string, score double")
    return out.withColumnsRenamed({f"kept_{i}": c for i, c in enumerate(keep)})


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: every fifth, by the crc32 of its id as text."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def identify_by_fold(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), key: str = "doc_id") -> DataFrame:
    """Languages of all rows, learned from those that aren't held out. Rows without id teach nothing."""
    model = learn(docs.where(F.col(key).isNotNull() & ~held_out(F.col(key))))
    rows = docs.withColumn("held_out", held_out(F.col(key)))
    return identify(rows, model, keep=(*keep, "held_out"))
