"""Fill-in-the-middle rewriting of texts, cut by a learned index from code points to bytes.

A text is cut at code points, but held as UTF-8. For a batch of texts the byte offsets of all code points are fitted
with straight lines: a cone of slopes is narrowed point by point and a line ends where no slope keeps every offset
within ``BOUND`` bytes. The index keeps the start of each line, its slope, and for every code point what the line is
off, in one byte. A cut is predicted by its line and put right by that byte, so it is exact. Texts of one byte a
character need one line, whatever their length.

What a text becomes is drawn from the digest of a seed and the row's id, so reruns agree: ``plain`` (as it was), ``psm``
(prefix, suffix, middle) or ``spm`` (suffix, prefix, middle), the parts behind the marks ``<P>``, ``<S>`` and ``<M>``.

A null text is an empty one; empty texts and those that hold a mark stay plain. A null id is drawn as an id without
digits. Repeated rows get the same result each. Texts are cut whole, whatever their length; a batch of texts is held in
memory at a time. Columns of other names take no part unless they are kept, and kept ones may bear any name but those
of the result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from moorage.llm.common import small_batches

BOUND = 127  # bytes a line may be off, so that residuals fit one byte
FIRST_WINDOW = 256
LAST_WINDOW = 1 << 16
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = "1"
PLAIN_SHARE, SPM_SHARE = 10, 20  # of a hundred


@dataclass(frozen=True)
class RankIndex:
    """Exact byte offset of every code point: lines, and by how much each offset lies off its line."""

    starts: np.ndarray  # first rank of each line
    bases: np.ndarray  # offset there
    slopes: np.ndarray
    residuals: np.ndarray  # one byte a rank

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        line = np.searchsorted(self.starts, ranks, side="right") - 1
        return predicted(self.bases[line], self.slopes[line], ranks - self.starts[line]) + self.residuals[ranks]


def predicted(base: np.ndarray, slope: np.ndarray, steps: np.ndarray) -> np.ndarray:
    return base + np.rint(slope * steps).astype(np.int64)


def line_from(offsets: np.ndarray, start: int) -> tuple[int, float]:
    """End and slope of the longest line from ``start`` that keeps within ``BOUND`` of every offset it passes."""
    low, high, slope = -np.inf, np.inf, 0.0
    at, window = start + 1, FIRST_WINDOW
    while at < len(offsets):
        part = offsets[at : at + window] - offsets[start]
        steps = np.arange(at - start, at - start + len(part))
        # Half a byte less on each side, as predictions are rounded.
        lows = np.maximum(np.maximum.accumulate((part - BOUND + 0.5) / steps), low)
        highs = np.minimum(np.minimum.accumulate((part + BOUND - 0.5) / steps), high)
        wrong = np.flatnonzero(lows > highs)
        good = int(wrong[0]) if len(wrong) else len(part)
        if good:
            low, high = float(lows[good - 1]), float(highs[good - 1])
            slope = (low + high) / 2
        if len(wrong):
            return at + good, slope
        at, window = at + len(part), min(2 * window, LAST_WINDOW)
    return len(offsets), slope


def rank_index(offsets: np.ndarray) -> RankIndex:
    """Index of the given offsets, which rise."""
    starts, slopes, residuals = [], [], np.zeros(len(offsets), np.int8)
    at = 0
    while at < len(offsets):
        end, slope = line_from(offsets, at)
        starts.append(at)
        slopes.append(slope)
        residuals[at:end] = offsets[at:end] - predicted(offsets[at], np.float64(slope), np.arange(end - at))
        at = end
    begins = np.array(starts, np.int64)
    return RankIndex(begins, offsets[begins] if len(begins) else begins, np.array(slopes, np.float64), residuals)


def raw_bytes(texts: pa.Array) -> tuple[memoryview, np.ndarray]:
    """All texts as one run of bytes, and where each begins and the last ends."""
    wide = texts.fill_null("").cast(pa.large_binary())
    places = np.frombuffer(wide.buffers()[1], np.int64, len(wide) + 1, wide.offset * 8)
    data = wide.buffers()[2]
    return memoryview(data if data is not None else b""), places


def assembled(batch: pa.RecordBatch) -> list[pa.Array]:
    """Number of code points, form, length of prefix and middle, and what the text becomes, of each row."""
    data, places = raw_bytes(batch.column("text"))
    begin, end = int(places[0]), int(places[-1])
    held = np.frombuffer(data[begin:end], np.uint8)
    boundaries = np.append(np.flatnonzero((held & 0xC0) != 0x80), len(held))
    index = rank_index(boundaries)
    firsts = np.searchsorted(boundaries, places - begin)
    counts = np.diff(firsts)
    draws = np.array([batch.column(f"h{i}").to_numpy(zero_copy_only=False) for i in (1, 2, 3, 4)], np.int64)
    one, two = draws[0] % (counts + 1), draws[1] % (counts + 1)
    cuts = np.minimum(one, two), np.maximum(one, two)
    at = [index.offsets(firsts[:-1] + cut) + begin for cut in cuts]

    forms, outputs = [], []
    for i, n in enumerate(counts.tolist()):
        text = bytes(data[places[i] : places[i + 1]])
        if not n or draws[2][i] % 100 >= 100 - PLAIN_SHARE or any(mark.encode() in text for mark in MARKS):
            forms.append(PLAIN)
            outputs.append(text)
            continue
        first, second = int(at[0][i] - places[i]), int(at[1][i] - places[i])
        prefix, middle, suffix = text[:first], text[first:second], text[second:]
        spm = draws[3][i] % 100 < SPM_SHARE
        forms.append(SPM if spm else PSM)
        parts = (b"<S>", suffix, b"<P>", prefix) if spm else (b"<P>", prefix, b"<S>", suffix)
        outputs.append(b"".join((*parts, b"<M>", middle)))
    plain = np.array([f == PLAIN for f in forms], bool)
    return [
        pa.array(counts, pa.int64()),
        pa.array(forms, pa.string()),
        pa.array(cuts[0], pa.int64(), mask=plain),
        pa.array(cuts[1] - cuts[0], pa.int64(), mask=plain),
        pa.array(outputs, pa.binary()),
    ]


def draws(key: Column, seed: str = SEED) -> list[Column]:
    """Four numbers below 2^32 from the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: tuple[str, ...] = (), seed: str = SEED) -> DataFrame:
    """Columns ``keep`` of each row, with n, form, prefix_chars, middle_chars and output."""
    kept = [F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, *draws(F.col(f"`{key}`"), seed), F.col(f"`{text}`").alias("text"))
    names = [f"kept_{i}" for i in range(len(keep))]

    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            columns = [batch.column(c) for c in names] + assembled(batch)
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n", "form", "prefix_chars", "middle_chars", "output"])

    schema = StructType([rows.schema[c] for c in names])
    for name, kind in (("n", LongType()), ("form", StringType()), ("prefix_chars", LongType()), ("middle_chars", LongType()), ("output", BinaryType())):
        schema = schema.add(name, kind)
    out = rows.mapInArrow(rewrite, schema)
    return out.withColumn("output", F.col("output").cast("string")).withColumnsRenamed(dict(zip(names, keep, strict=True)))


def restored(output: Column, form: Column) -> Column:
    """The text again. The parts hold no marks, so these divide an output in one way only."""
    part = F.split(output, "<[PSM]>", -1)
    psm = F.concat(part[1], part[3], part[2])
    return F.when(form == PLAIN, output).when(form == PSM, psm).otherwise(F.concat(part[2], part[3], part[1]))
