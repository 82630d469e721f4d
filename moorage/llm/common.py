"""What several operators share: joins of checked size, words of a text in bounded pieces, and bounded caches."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_BYTES = 64 * 1024 * 1024

_held: dict[tuple, object] = {}  # of a worker


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def join_stored(rows: DataFrame, stored: DataFrame, on: list[str], how: str, row_bytes: int) -> DataFrame:
    """Join with a stored table: broadcast if its counted rows, at ``row_bytes`` each, fit the bound.

    Beyond the bound it is a shuffle join on ``on``, which Spark splits where a key is hot.
    """
    if stored.count() * row_bytes <= BROADCAST_BYTES:
        return rows.join(F.broadcast(stored), on, how)
    return rows.join(stored.hint("merge"), on, how)


def pieces(text: bytes, separator: re.Pattern[bytes], size: int = 1 << 20) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes that end where ``separator`` matches, so no word is cut."""
    start = 0
    while len(text) - start > size:
        cut = separator.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:] if start else text


class Memo(dict):
    """Cache by text of about ``limit`` entries: two generations, of which the older goes when the newer is full."""

    def __init__(self, limit: int, longest: int) -> None:
        super().__init__()
        self.limit, self.longest = limit, longest
        self.old: dict = {}

    def fill(self, wanted: set, make: Callable[[list], Iterable]) -> None:
        """Afterwards all wanted keys of up to ``longest`` characters are there. ``make`` gives the values of keys."""
        missing = [key for key in wanted if key not in self]
        if not missing:
            return
        if len(self) + len(missing) > self.limit // 2:
            self.old = dict(self)
            self.clear()
            missing = list(wanted)
        if self.old:
            self.update({key: self.old[key] for key in missing if key in self.old})
            missing = [key for key in missing if key not in self.old]
        new = [key for key in missing if len(key) <= self.longest]
        self.update(zip(new, make(new), strict=True))


def held_model(make: Callable[[str], object], file: str) -> object:
    """The model that this worker holds with its caches, from task to task; one at a time."""
    if (make, file) not in _held:
        forget_models()
        _held[make, file] = make(file)
    return _held[make, file]


def forget_models() -> None:
    """For tasks without a model. Workers go from stage to stage, and what an earlier one held counts as the executor's memory."""
    if _held:
        _held.clear()
        gc.collect()
    give_back()


def give_back() -> None:
    """What this worker has freed goes back to the system; the allocators would keep it, for every worker that idles."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def lean(task: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task, after which the worker gives back what it has freed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        give_back()

    return run


def split_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts cut at each space: the different words, the number of each word of all texts in these, offsets of the texts."""
    import pyarrow.compute as pc

    lists = pc.split_pattern(texts, " ")
    coded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), offsets - offsets[0]


def joined_array(values: pa.Array, numbers: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """For each stretch between offsets, the values (large_binary) with these numbers joined."""
    taken = values.take(pa.array(numbers))
    places = np.frombuffer(taken.buffers()[1], "<i8", len(taken) + 1, taken.offset * 8)[offsets]
    data = taken.buffers()[2] or pa.py_buffer(b"")
    return pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places), data])


def joined(values: list[bytes] | pa.Array, numbers: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """``joined_array`` as a list, also of a list."""
    values = values if isinstance(values, pa.Array) else pa.array(values, pa.large_binary())
    return joined_array(values, numbers, offsets).to_pylist()


def small_batches(batches: Iterable[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``limit`` bytes of text each; a single longer text stays whole."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if len(sizes) > start:
            yield batch.slice(start)
