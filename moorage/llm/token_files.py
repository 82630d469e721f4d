"""Token ids as binary files of patched frame-of-reference blocks.

The ids of all documents, in ascending order of the documents' ids and each with an end id, make one stream. It is cut
by ranges of document ids into segments, and a segment into blocks of ``BLOCK`` ids. Of a block the minimum is
subtracted and the rest packed at a width that ``PERCENTILE`` of its values fit; the high bits of the others are kept
in a list of exceptions (places and values). The segment ends with the byte at which each block starts, so one block
can be read without the others.

Ranges are quantiles of the document ids, found without encoding anything. Each text is then
encoded where it is read, and only ids are shuffled. Spark writes the files and reads them back, so the folder may be
any that Spark can write, and a lost executor costs its tasks alone.

A null text counts as empty and has the end id only. Rows without id come first. Rows of the same id stay side by
side, in the order of their ids' checksums. An empty table gives no segments and an empty table.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, count, groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from moorage.llm.common import forget_models, held_model, joined, joined_array, lean, small_batches, split_words
from moorage.session import new_location

BLOCK = 256
PERCENTILE = 90
SEGMENT_BYTES = 8 << 20  # of text, about
MAX_RANGES = 20_000
END_ID = 0
ENCODED_BYTES = 16 << 20  # of text at once
# Beyond either bound a worker forgets the parts it met before.
CACHED_PARTS = 300_000
CACHED_BYTES = 16 << 20
AT_ONCE = 1 << 14  # chunks or parts
# No text holds this character. Within Latin letters the library's rule for cutting is the pattern CUT, with STOP as the
# end of a text, but for characters that Python classes otherwise.
STOP = "\udcff"
UNLIKE = re.compile("[\x1c-\x1f\u00b2\u00b3\u00b9\u00bc-\u00be\u0250-\ud7ff\ue000-\U0010ffff]")
CUT = re.compile(rf"{STOP}|'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\w\s{STOP}]|_)+|\s+(?![^\s{STOP}])|\s+")
WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
GLUED = f" [{WHITE}]|[{WHITE}] "  # in texts whose chunks aren't what lies between spaces

# Layout of a segment. Head: magic, documents, blocks, ids, bytes of the whole segment.
MAGIC = b"PFOR"
HEAD = struct.Struct("<4sIIQQ")
BLOCK_HEAD = struct.Struct("<IHBxI")
BLOCK_DTYPE = np.dtype([("exceptions", "<u4"), ("count", "<u2"), ("width", "u1"), ("", "u1"), ("least", "<u4")])


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of each value of each row, least first; a row of bytes for each."""
    kind = "<u2" if width <= 16 else "<u4"
    bytes_of = values.astype(kind).view("u1").reshape(*values.shape, np.dtype(kind).itemsize)
    bits = np.unpackbits(bytes_of, axis=-1, bitorder="little")
    return np.packbits(bits[..., :width].reshape(len(values), -1), axis=1, bitorder="little")


def unpack(data: np.ndarray, width: int, count: int) -> np.ndarray:
    """Rows of ``count`` values from rows of bytes. Eight values fill ``width`` bytes, and each lies in five of them at most."""
    if not width:
        return np.zeros((len(data), count), np.uint32)
    groups = (count + 7) // 8
    padded = np.zeros((len(data), groups * width + 5), np.uint8)
    padded[:, : data.shape[1]] = data
    values = np.empty((len(data), groups, 8), np.uint32)
    for i in range(8):
        first, shift = divmod(i * width, 8)
        kind = np.uint32 if shift + width <= 32 else np.uint64
        value = np.zeros((len(data), groups), kind)
        for byte in range((shift + width + 7) // 8):
            at = first + byte
            value |= padded[:, at : at + groups * width : width][:, :groups].astype(kind) << kind(8 * byte)
        values[..., i] = (value >> kind(shift)) & kind((1 << width) - 1)
    return values.reshape(len(data), -1)[:, :count]


def encode_rows(rows: np.ndarray) -> list[bytes]:
    """A block of bytes for each row of ids; blocks of one width are packed together."""
    if not len(rows):
        return []
    least = rows.min(axis=1)
    rest = rows - least[:, None]
    at = (rows.shape[1] - 1) * PERCENTILE // 100
    typical = np.partition(rest, at, axis=1)[:, at]
    widths = np.ceil(np.log2(typical.astype(np.float64) + 1)).astype(int)
    high = (rest.astype(np.uint64) >> widths[:, None].astype(np.uint64)).astype("<u4")
    owners, places = np.nonzero(high)
    first = np.searchsorted(owners, np.arange(len(rows) + 1))
    places, high = places.astype("<u2"), high[owners, places]
    blocks: list[bytes] = [b""] * len(rows)
    for width in np.unique(widths):
        same = np.flatnonzero(widths == width)
        for i, packed in zip(same, pack(rest[same], width), strict=True):
            mine = slice(first[i], first[i + 1])
            head = BLOCK_HEAD.pack(first[i + 1] - first[i], rows.shape[1], width, least[i])
            blocks[i] = head + packed.tobytes() + places[mine].tobytes() + high[mine].tobytes()
    return blocks


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    whole = len(ids) // BLOCK * BLOCK
    last = ids[whole:]
    return encode_rows(ids[:whole].reshape(-1, BLOCK)) + (encode_rows(last[None, :]) if len(last) else [])


def decode_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at these bytes."""
    if not len(starts):
        return np.empty(0, np.uint32)
    heads = data[starts[:, None] + np.arange(BLOCK_HEAD.size)].view(BLOCK_DTYPE)[:, 0]
    counts, widths = heads["count"].astype(np.int64), heads["width"].astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    ids = np.empty(offsets[-1], np.uint64)
    for width, count in {(int(w), int(c)) for w, c in zip(widths, counts, strict=True)}:
        same = np.flatnonzero((widths == width) & (counts == count))
        packed = data[(starts[same] + BLOCK_HEAD.size)[:, None] + np.arange((count * width + 7) // 8)]
        ids[offsets[same][:, None] + np.arange(count)] = unpack(packed, width, count)
    exceptions = heads["exceptions"].astype(np.int64)
    if exceptions.sum():
        owners = np.repeat(np.arange(len(starts)), exceptions)
        order = np.arange(len(owners)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        lists = starts + BLOCK_HEAD.size + (counts * widths + 7) // 8
        places = data[(lists[owners] + 2 * order)[:, None] + np.arange(2)].view("<u2")[:, 0]
        high = data[(lists[owners] + 2 * exceptions[owners] + 4 * order)[:, None] + np.arange(4)].view("<u4")[:, 0]
        ids[offsets[owners] + places] |= high.astype(np.uint64) << widths[owners].astype(np.uint64)
    return (ids + np.repeat(heads["least"].astype(np.uint64), counts)).astype(np.uint32)


def encode_segment(keys: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """Head, document ids (with a flag for missing ones) and their counts, blocks, starts of the blocks."""
    blocks = encode_blocks(ids)
    there = np.array([k is not None for k in keys], "u1").tobytes()
    front = np.array([k or 0 for k in keys], "<i8").tobytes() + np.array(counts, "<u8").tobytes() + there
    starts = np.cumsum([HEAD.size + len(front), *[len(b) for b in blocks]])[:-1].astype("<u8").tobytes()
    body = b"".join(blocks)
    size = HEAD.size + len(front) + len(body) + len(starts)
    return HEAD.pack(MAGIC, len(keys), len(blocks), len(ids), size) + front + body + starts


def decode_segment(data: np.ndarray) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    magic, documents, blocks, total, size = HEAD.unpack(data[: HEAD.size].tobytes())
    if magic != MAGIC:
        raise ValueError("not a segment of token ids")
    at = HEAD.size
    keys = data[at : at + 8 * documents].copy().view("<i8")
    counts = data[at + 8 * documents : at + 16 * documents].copy().view("<u8").astype(np.int64)
    there = data[at + 16 * documents : at + 17 * documents]
    starts = data[size - 8 * blocks : size].copy().view("<u8").astype(np.int64)
    stream = decode_blocks(data, starts)
    if len(stream) != total:
        raise ValueError("a segment of token ids is damaged")
    return [int(k) if t else None for k, t in zip(keys, there, strict=True)], counts, stream


class ChunkEncoder:
    """Ids of whole texts from a tokenizer of the byte-level kind, whose tokens never hold a space but in front.

    A single space between two characters that aren't white space begins a token, so what lies between such spaces, a
    chunk, is looked up by itself, once a batch. All chunks of a batch are cut together by the library's rule (in Latin
    script by a pattern that says the same), and the parts not met before go to the library's model. Parts have numbers,
    and the ids of chunks and texts are gathered by these, in columns.
    """

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        if self.tokenizer.normalizer is not None or not str(self.tokenizer.pre_tokenizer).startswith("ByteLevel(add_prefix_space=False"):
            raise ValueError("the tokenizer must be of the byte-level kind, without normaliser and added spaces")
        self.model, self.cut = self.tokenizer.model, self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([*map(re.escape, self.special), GLUED])
        self.shown = byte_characters() | {0xFF: "\n"}  # STOP as a byte, which UTF-8 doesn't have; no byte is shown as a line end
        self._forget()

    def _forget(self) -> None:
        """Number 0 is STOP, without ids. Those of part ``i`` lie between ``ends[i]`` and ``ends[i + 1]``."""
        self.parts: defaultdict[str, int] = defaultdict(count().__next__)
        self.ids, self.ends, self.size = array("I"), array("q", [0] * (self.parts[STOP] + 2)), 0

    def _cut(self, keys: list[str]) -> Iterator[list[str]]:
        """The parts of these chunks, with STOP after each chunk."""
        for start in range(0, len(keys), AT_ONCE):
            texts = list(map(text_of, keys[start : start + AT_ONCE]))
            whole = STOP.join([*texts, ""])
            if UNLIKE.search(whole) is None:
                yield CUT.findall(whole)
                continue
            for unlike, run in groupby(texts, lambda text: UNLIKE.search(text) is not None):
                if unlike:
                    for text in run:
                        yield [*(text[first:end] for _, (first, end) in self.cut(text)), STOP]
                else:
                    yield CUT.findall(STOP.join([*run, ""]))

    def _learn(self, parts: list[str]) -> None:
        tokenize, ids, ends = self.model.tokenize, self.ids, self.ends
        for start in range(0, len(parts), AT_ONCE):
            data = STOP.join(parts[start : start + AT_ONCE]).encode("utf-8", "surrogateescape")
            for shown in data.decode("latin-1").translate(self.shown).split("\n"):
                ids.extend([token.id for token in tokenize(shown)])
                ends.append(len(ids))
            self.size += len(data)

    def split(self, text: str) -> list[str]:
        """Keys of the chunks: the chunk without the space it begins with, or with one more if it begins with none."""
        keys = text.split(" ")
        chunks: list[str] = []
        glued = False
        for number, part in enumerate(keys):
            # A space next to white space belongs to the chunk before.
            if chunks and (glued or not part or part[0].isspace()):
                chunks[-1] += " " + part
            else:
                chunks.append(" " + part if number else part)
            glued = not part or part[-1].isspace()
        return [c[1:] if c[:1] == " " != c[1:2] else " " + c for c in chunks]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids as 32-bit integers, for each text. Each different chunk is looked up once."""
        import pyarrow.compute as pc

        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        results: list[bytes] = [b""] * len(texts)
        places = np.flatnonzero(~odd).tolist()
        keys, numbers, offsets = split_words(texts.take(pa.array(places, pa.int64())))
        more: defaultdict[str, int] = defaultdict(count(len(keys)).__next__)
        # The first chunk of a text has no space in front.
        numbers = numbers.copy()
        numbers[offsets[:-1]] = [more[" " + keys[number]] for number in numbers[offsets[:-1]]]
        others, ends = array("i"), array("q")
        for i in np.flatnonzero(odd).tolist():
            text = texts[i].as_py()
            if any(token in text for token in self.special):
                results[i] = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
                continue
            others.extend([more[key] for key in self.split(text)])
            ends.append(len(numbers) + len(others))
            places.append(i)
        numbers, offsets = np.concatenate([numbers, np.array(others, np.int32)]), np.concatenate([offsets, np.array(ends, np.int64)])
        for i, ids in zip(places, joined(self._known([*keys, *more]), numbers, offsets), strict=True):
            results[i] = ids
        return results

    def _known(self, keys: list[str]) -> pa.Array:
        """The ids of each of these chunks."""
        if len(self.parts) > CACHED_PARTS or self.size > CACHED_BYTES:
            self._forget()
        held = len(self.parts)
        numbers = np.fromiter(map(self.parts.__getitem__, chain.from_iterable(self._cut(keys))), np.int32)
        self._learn(list(islice(self.parts, held, None)))
        places = pa.py_buffer(np.array(self.ends) * self.ids.itemsize)
        ids = pa.Array.from_buffers(pa.large_binary(), len(self.parts), [None, places, pa.py_buffer(self.ids.tobytes())])
        return joined_array(ids, numbers, np.concatenate([[0], np.flatnonzero(numbers == 0) + 1]))


def byte_characters() -> dict[int, str]:
    """The character that byte-level tokenizers show each byte as: itself where it can be seen, else one from 256 on."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    unseen = [byte for byte in range(256) if byte not in seen]
    return {byte: chr(byte) for byte in seen} | {byte: chr(256 + i) for i, byte in enumerate(unseen)}


def text_of(key: str) -> str:
    return key[1:] if key[:1] == " " else " " + key


def key_ranges(docs: DataFrame, key: str, text: str) -> list[int]:
    """Document ids at which a new range begins, so that a range holds about ``SEGMENT_BYTES`` of text on average."""
    keys = docs.select(F.col(key).cast("bigint").alias("key"), F.octet_length(text).alias("size"))
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    count = min(MAX_RANGES, total // SEGMENT_BYTES + 1)
    if count == 1:
        return []
    cuts = F.percentile_approx("key", [i / count for i in range(1, count)], 20 * count)
    return sorted(set(keys.agg(cuts).first()[0] or []))


def write_tokens(docs: DataFrame, tokenizer_file: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> str:
    """Encodes all texts and writes the segments, one row of bytes each; the folder."""
    cuts = key_ranges(docs, key, text)
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    starts = np.array(cuts, np.int64)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, end = held_model(ChunkEncoder, tokenizer_file), np.uint32(end_id).tobytes()
        for batch in small_batches(batches, "text", ENCODED_BYTES):
            ids = [i + end for i in model.encode(batch.column("text").fill_null(""))]
            keys = batch.column("key")
            parts = np.where(keys.is_null(), 0, np.searchsorted(starts, keys.fill_null(0).to_numpy(), side="right"))
            small = [np.frombuffer(i, "<u4").astype("<u2").tobytes() if max_id(i) < 1 << 16 else b"\x00" + i for i in ids]
            columns = [pa.array(parts, pa.int32()), keys, pa.array(small, pa.binary()), pa.array(map(zlib.crc32, ids), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "key", "ids", "check"])

    def max_id(ids: bytes) -> int:
        return int(np.frombuffer(ids, "<u4").max())

    def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of (part, key); a segment is closed at the end of a part or beyond its size."""
        forget_models()
        part, keys, held, size = None, [], [], 0

        def close() -> pa.RecordBatch:
            ids = [np.frombuffer(i[1:], "<u4") if len(i) % 2 else np.frombuffer(i, "<u2") for i in held]
            data = encode_segment(keys, [len(i) for i in ids], np.concatenate(ids).astype(np.uint32))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([data], pa.binary())], names=["part", "content"])

        for batch in batches:
            for row in zip(batch.column("part").to_pylist(), batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if keys and (row[0] != part or size >= SEGMENT_BYTES):
                    yield close()
                    keys, held, size = [], [], 0
                part = row[0]
                keys.append(row[1])
                held.append(row[2])
                size += len(row[2])
        if keys:
            yield close()

    encoded = rows.mapInArrow(lean(encode), "part int, key bigint, ids binary, check bigint")
    dealt = encoded.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", F.col("key").asc_nulls_first(), "check")
    location = new_location(docs.sparkSession, "tokens")
    # Files come in the order of the parts; Spark's text writer adds a line end after each segment.
    dealt.mapInArrow(lean(segments), "part int, content binary").select(F.col("content").cast("string")).write.text(location)
    return location


def _parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array, pa.Array, np.ndarray, np.ndarray]]:
    """File name, places and document ids of each segment, with the offsets of documents in its ids, and these."""
    forget_models()
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            data = np.frombuffer(content.as_buffer(), np.uint8)
            at = place = 0
            while at < len(data):
                size = HEAD.unpack(data[at : at + HEAD.size].tobytes())[-1]
                keys, counts, ids = decode_segment(data[at : at + size])
                names = pa.array([path.rpartition("/")[2]] * len(keys), pa.string())
                places = pa.array(range(place, place + len(keys)), pa.int64())
                yield names, places, pa.array(keys, pa.int64()), np.concatenate([[0], np.cumsum(counts)]), ids
                at, place = at + size + 1, place + len(keys)


def _files(spark: SparkSession, location: str) -> DataFrame:
    return spark.read.format("binaryFile").load(location).where("length > 0").select("path", "content")


def read_tokens(spark: SparkSession, location: str) -> DataFrame:
    """Per document of the files: file, place in it, doc_id, ids."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, place, keys, offsets, ids in _parsed(batches):
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype("i4")), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays([file, place, keys, lists], names=["file", "place", "doc_id", "ids"])

    return _files(spark, location).mapInArrow(lean(read), "file string, place bigint, doc_id bigint, ids array<int>")


def token_report(spark: SparkSession, location: str) -> DataFrame:
    """Per document of the files: file, place in it, doc_id, n_tokens, and the checksum of its ids."""

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, place, keys, offsets, ids in _parsed(batches):
            data = memoryview(ids.astype("<u4").tobytes())
            sums = [zlib.crc32(data[4 * s : 4 * e]) for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
            columns = [file, place, keys, pa.array(np.diff(offsets), pa.int64()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "place", "doc_id", "n_tokens", "ids_crc32"])

    schema = "file string, place bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"
    return _files(spark, location).mapInArrow(lean(check), schema)


def with_starts(report: DataFrame) -> DataFrame:
    """Adds the number of ids of all documents before: within a file, and of the files before it.

    ``report`` is stored. The first window holds one row per file.
    """
    files = report.groupBy("file").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    ahead = files.select("file", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    own = report.withColumn("within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return own.join(F.broadcast(ahead), "file").select(
        "doc_id", (F.col("ahead") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )
