"""Quality of texts by the votes of their nearest labelled neighbours in a latent-semantic space.

Terms of a text are of two kinds, each hashed to its own buckets: three neighbouring runs of its shape (letters of one
case, digits, blanks, one kind of punctuation), and for each word what it repeats (whether it equals one of the
``LAGS`` words before it) with its length and shape. They count whatever a text is about, in any language. A term weighs
the square root of its share in its kind, times the logarithm of the documents it is rare in; documents are counted over
the whole corpus. The largest singular vectors of the examples' weights span the space, in which all texts are compared.

Examples are a bounded sample: at most ``EXAMPLES`` labelled documents, half of that of each label, those with the least
digest of their id, however many there are. Votes make up for it: an example stands for as many documents as its label
has per example. The vectors of the examples are broadcast, and every document gets its exact cosine with each, in
blocks. The ``NEIGHBOURS`` nearest vote, with all that are as near as the last of them, weighted by similarity to the
power ``SHARPNESS``; the score is the share of label 1, drawn a little towards its share among all labels.

A null text is an empty one; a text without terms has the term of having none, so it is near to its like. Texts are taken
whole, in pieces of ``CHARS`` bytes that end at blanks. Labels other than 0 and 1 and those of documents that aren't there teach
nothing, nor do null ids. An id with both labels is an example of each; of documents that share an id one is taken, the
least by digest and text. Where nothing was learned every score is 0.5. Repeated rows get their result each, and equal
texts equal ones. Columns of other names take no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructType

from moorage.llm.common import pieces, small_batches
from moorage.session import materialise

SHAPE_BUCKETS = 2048
WORD_BUCKETS = 2048
TERMS = SHAPE_BUCKETS + WORD_BUCKETS
LAGS = 4
CHARS = 1 << 20
DIMENSIONS = 32
EXAMPLES = 4096
NEIGHBOURS = 15
SHARPNESS = 4
BLOCK = 512  # rows compared at once
PRIOR_VOTES = 0.05
THRESHOLD = 0.3

BLANK = re.compile(rb"[\x20\x09-\x0D]")
LOWER, UPPER, LETTER, DIGIT, SPACE, LINE, OTHER = range(1, 8)
FIRST_MARK = 8  # ASCII punctuation, each its own
MULTIPLIER = np.uint32(0x9E3779B1)


def kind_of(point: int) -> int:
    char = chr(point)
    if char.islower():
        return LOWER
    if char.isupper():
        return UPPER
    if char.isalpha():
        return LETTER
    if char.isdigit():
        return DIGIT
    if point in (10, 13):
        return LINE
    if char.isspace():
        return SPACE
    return FIRST_MARK + point - 32 if 32 < point < 127 else OTHER


class Kinds:
    """Kinds of code points, told once each."""

    def __init__(self) -> None:
        self.known = np.zeros(0x110000, np.uint8)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        found = self.known[points]
        if not found.all():
            for point in np.unique(points[found == 0]).tolist():
                self.known[point] = kind_of(point)
            found = self.known[points]
        return found


KINDS = Kinds()


def mixed(*values: np.ndarray) -> np.ndarray:
    """One hash of the values at each place."""
    total = np.zeros(len(values[0]), np.uint32)
    for value in values:
        total = (total ^ value.astype(np.uint32)) * MULTIPLIER
        total ^= total >> np.uint32(15)
    return total


def shape_terms(kinds: np.ndarray) -> np.ndarray:
    """Buckets of three neighbouring runs of one kind each; a run counts as one, two or more characters."""
    starts = np.flatnonzero(np.diff(kinds, prepend=0))
    size = np.minimum(np.diff(starts, append=len(kinds)), 3)
    runs = kinds[starts].astype(np.uint32) * 4 + size
    edged = np.concatenate([[0], runs if len(runs) else [0], [0]]).astype(np.uint32)
    return mixed(edged[:-2], edged[1:-1], edged[2:]) % np.uint32(SHAPE_BUCKETS)


def word_terms(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Buckets of what each word repeats, with its length and its first and last kind."""
    inside = (kinds != SPACE) & (kinds != LINE)
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.empty(0, np.uint32)
    at = np.arange(len(points))
    place = at - np.maximum.accumulate(np.where(edges[:-1] == 1, at, 0))
    hashes = np.add.reduceat(np.where(inside, mixed(points, place), 0).astype(np.uint64), starts)
    lag = np.zeros(len(starts), np.uint32)
    for back in range(LAGS, 0, -1):
        lag[back:][hashes[back:] == hashes[:-back]] = back
    length = np.minimum(ends - starts, 24)
    return np.uint32(SHAPE_BUCKETS) + mixed(lag + 1, length, kinds[starts], kinds[ends - 1]) % np.uint32(WORD_BUCKETS)


def term_counts(text: bytes) -> np.ndarray:
    """How often each term occurs in a text."""
    counts = np.zeros(TERMS, np.int64)
    for piece in pieces(text, BLANK, CHARS):
        points = np.frombuffer(piece.decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
        kinds = KINDS(points)
        counts += np.bincount(shape_terms(kinds), minlength=TERMS)
        counts += np.bincount(word_terms(points, kinds), minlength=TERMS)
    return counts


def shares(texts: pa.Array) -> np.ndarray:
    """Square root of the share of each term in its kind, by text."""
    rows = np.array([term_counts(t) for t in texts.fill_null("").cast(pa.large_binary()).to_pylist()], np.float32)
    for part in (rows[:, :SHAPE_BUCKETS], rows[:, SHAPE_BUCKETS:]):
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1)
    return np.sqrt(rows)


def batches_of_shares(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in small_batches(batches, "text"):
        for start in range(0, len(batch), BLOCK):
            part = batch.slice(start, BLOCK)
            yield part, shares(part.column("text"))


def document_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of a task each term occurs, and how many there are (as term ``TERMS``)."""
    counts = np.zeros(TERMS + 1, np.int64)
    for part, rows in batches_of_shares(batches):
        counts[:TERMS] += np.count_nonzero(rows, axis=0)
        counts[TERMS] += len(part)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], names=["term", "n"])


def example_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms and their weights of the examples, as lists."""
    for part, rows in batches_of_shares(batches):
        terms = [np.flatnonzero(row) for row in rows]
        lists = [pa.array(terms, pa.list_(pa.int32())), pa.array([row[t] for row, t in zip(rows, terms, strict=True)], pa.list_(pa.float32()))]
        yield pa.RecordBatch.from_arrays([part.column("label"), *lists], names=["label", "terms", "weights"])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # by term
    space: np.ndarray  # terms by dimensions
    vectors: np.ndarray  # examples by dimensions, of length one
    labels: np.ndarray
    votes: np.ndarray  # how many documents an example stands for, in units of the mean
    prior: float


def term_weights(counts: np.ndarray) -> np.ndarray:
    return np.log1p(max(1, counts[TERMS]) / np.maximum(counts[:TERMS], 1)).astype(np.float32)


def singular_space(matrix: np.ndarray, dimensions: int = DIMENSIONS, rounds: int = 6) -> np.ndarray:
    """The right singular vectors of the largest singular values, by iterating a subspace from a fixed start."""
    width = min(dimensions, *matrix.shape)
    wide = np.random.default_rng(1).standard_normal((matrix.shape[1], min(2 * dimensions, matrix.shape[1])))
    for _ in range(rounds):
        wide = np.linalg.qr(matrix.T @ (matrix @ wide))[0]
    _, _, small = np.linalg.svd(matrix @ wide, full_matrices=False)
    return (wide @ small[:width].T).astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def fitted(counts: np.ndarray, examples: np.ndarray, labels: np.ndarray, totals: dict[int, int]) -> Model:
    """``examples``: shares by example. ``totals``: how many labelled documents there are of each label."""
    weights = term_weights(counts)
    weighted = unit(examples * weights).astype(np.float64)
    space = singular_space(weighted)
    share = {label: totals[label] / max(1, int((labels == label).sum())) for label in totals}
    votes = np.array([share[int(label)] for label in labels])
    everything = sum(totals.values())
    return Model(weights, space, unit(weighted @ space).astype(np.float32), labels, votes / votes.mean(), totals.get(1, 0) / max(1, everything))


def voted(rows: np.ndarray, model: Model) -> np.ndarray:
    """Scores of documents from their shares."""
    vectors = unit((rows * model.weights) @ model.space)
    # Rounded, so that the place of a document in its block doesn't tell.
    near = np.round(np.clip(vectors @ model.vectors.T, 0, 1), 5)
    k = min(NEIGHBOURS, near.shape[1])
    last = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
    who, whom = np.nonzero(near >= last[:, None])
    power = near[who, whom].astype(np.float64) ** SHARPNESS * model.votes[whom]
    good = np.bincount(who, power * (model.labels[whom] == 1), len(near))
    scores = (good + PRIOR_VOTES * model.prior) / (np.bincount(who, power, len(near)) + PRIOR_VOTES)
    return np.round(np.clip(scores, 0, 1), 6)


def chosen_examples(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, bound: int) -> tuple[DataFrame, dict[int, int]]:
    """Label and text of at most ``bound`` documents, in a fixed order, and how many documents bear each label.

    Ids alone are shuffled to find which labels have a document; the texts of the chosen few are fetched by a broadcast of
    their ids.
    """
    known = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.where("key IS NOT NULL AND label IN (0, 1)").distinct()
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).where("key IS NOT NULL")
    known = materialise(known.join(rows.select("key").distinct(), "key", "left_semi"), "labels")
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    drawn = known.withColumn("drawn", F.md5(F.col("key").cast("string")))
    halves = [drawn.where(F.col("label") == one).orderBy("drawn", "key").limit(bound // 2) for one in (0, 1)]
    sample = materialise(halves[0].unionByName(halves[1]), "sample")
    met = rows.join(F.broadcast(sample.select("key").distinct()), "key", "left_semi")
    ordered = F.struct(F.xxhash64("text").alias("digest"), "text")
    texts = met.groupBy("key").agg(F.min(ordered)["text"].alias("text"))
    return texts.join(F.broadcast(sample), "key").select("label", "text", "drawn", "key"), totals


def learn(docs: DataFrame, taught: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", bound: int = EXAMPLES) -> Model | None:
    """The model from documents ``taught`` that have labels, with terms weighted by their rarity in all ``docs``."""
    examples, totals = chosen_examples(taught, labels, text, key, label, bound)
    if not totals:
        return None
    counted = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(document_counts, "term int, n bigint")
    rare = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(TERMS + 1, np.int64)
    counts[rare.column("term").to_numpy()] = rare.column("n").to_numpy()
    ordered = examples.orderBy("drawn", "key", "label").select("label", "text")
    lists = ordered.mapInArrow(example_rows, "label int, terms array<int>, weights array<float>").toArrow()
    matrix = np.zeros((len(lists), TERMS), np.float32)
    for row, terms, weights in zip(matrix, lists.column("terms"), lists.column("weights"), strict=True):
        row[terms.values.to_numpy()] = weights.values.to_numpy()
    return fitted(counts, matrix, lists.column("label").to_numpy(), totals)


def score(docs: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of each row with the score of its text, and predicted: whether that reaches ``THRESHOLD``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"kept_{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").alias("text"))

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in batches_of_shares(batches):
            scores = np.full(len(part), 0.5) if sent.value is None else voted(found, sent.value)
            yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], pa.array(scores)], names=[*names, "score"])

    schema = StructType([rows.schema[n] for n in names]).add("score", DoubleType())
    judged = rows.mapInArrow(judge, schema).withColumnsRenamed(dict(zip(names, keep, strict=True)))
    return judged.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def score_by_fold(docs: DataFrame, labels: DataFrame, fold: Column, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Scores of all rows, learned from the labels of those that ``fold`` doesn't hold out."""
    model = learn(docs, docs.where(~fold), labels)
    return score(docs.withColumn("held_out", fold), model, keep=(*keep, "held_out"))
