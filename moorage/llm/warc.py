"""WARC archives with revisits, and capture histories by an external index merge.

Writing: payloads are told apart by SHA-256. Of rows with one payload of at least ``REVISIT_BYTES`` bytes that with the
smallest id becomes the response, the others revisits without payload. Spark's text writer makes the archives: a
record is a row, and what separates rows is the two line ends that close a record.

Reading: each archive is parsed record by record, its payloads digested anew and compared with what the records say.
The captures of an archive are sorted by URL key and time: a run. Runs are stored, their keys cut into ranges of a
bounded number of captures, and the parts of all runs within a range merged by a tree of losers. Ranges follow each
other, so the whole is in the order of URL key and time, and each history is in one place.

A null payload is empty, and so a response; a null URL is left out of the record and has an empty key. Rows without
id are never the one that others refer to. Rows that repeat an id with the same payload are responses all. An empty
table gives archives without records and an empty index. Line ends in URLs are percent-encoded.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from moorage.llm.common import join_stored
from moorage.session import materialise, new_location

REVISIT_BYTES = 100
ARCHIVE_RECORDS = 16_384
RANGE_CAPTURES = 50_000

# What a WARC record looks like.
VERSION = "WARC/1.0"
LINE = "\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

INDEX = {
    "url_key": "string",
    "captured": "string",
    "record_id": "bigint",
    "archive": "string",
    "position": "bigint",
    "record_type": "string",
    "payload_bytes": "bigint",
    "payload_digest": "string",
    "refers_to": "bigint",
}
ARROW = {"string": pa.string(), "bigint": pa.int64()}
INDEX_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in INDEX.items())
ARROW_SCHEMA = pa.schema([(name, ARROW[kind]) for name, kind in INDEX.items()])


def url_key(url: str) -> str:
    """The host in lower case, its labels from right to left, then the rest: pages of a site sort together."""
    _, found, rest = url.partition("://")
    if not found:
        return url
    host, slash, path = rest.partition("/")
    return ",".join(reversed(host.lower().split("."))) + ")" + slash + path


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(LINE)), F.lit(""))


def _urn(value: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), value.cast("string"), F.lit(">"))


def write_archives(rows: DataFrame) -> str:
    """Writes rows (record_id, url, captured, payload), captured being a timestamp; the folder of the archives."""
    payload = F.coalesce(F.col("payload"), F.lit(""))
    known = rows.select("record_id", "url", "captured", payload.alias("payload"))
    known = known.withColumn("bytes", F.octet_length("payload").cast("bigint")).withColumn("digest", F.sha2("payload", 256))
    alike = known.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest")
    repeated = alike.agg(F.min("record_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = join_stored(known, materialise(repeated, "warc-repeated"), ["digest"], "left", 100)
    # Of rows with one payload but no id at all, none can be referred to.
    revisit = F.col("first").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("first"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    url = reduce(lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])), [("\r", "%0D"), ("\n", "%0A")], F.col("url"))
    record = F.concat(
        F.lit(VERSION + LINE),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _urn(F.col("record_id"))),
        _header("WARC-Date", F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _header("WARC-Target-URI", url),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _header("WARC-Refers-To", F.when(revisit, _urn(F.col("first")))),
        _header("WARC-Profile", F.when(revisit, F.lit(SAME_PAYLOAD))),
        _header("X-Payload-Length", F.col("bytes").cast("string")),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("Content-Length", F.octet_length(body).cast("string")),
        F.lit(LINE),
        body,
    )
    location = new_location(rows.sparkSession, "archives")
    writer = joined.select(record.alias("record")).write.option("lineSep", LINE * 2).option("compression", "gzip")
    writer.option("maxRecordsPerFile", ARCHIVE_RECORDS).text(location)
    return location


def records(archive: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Position in the unpacked archive, headers and block of each record."""
    file = gzip.GzipFile(fileobj=io.BytesIO(archive))
    while True:
        position = file.tell()
        line = file.readline()
        if not line:
            return
        if line.rstrip() != VERSION.encode():
            raise ValueError(f"no record at {position}")
        headers = {}
        while line := file.readline().rstrip(b"\r\n"):
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        size = int(headers["Content-Length"])
        block = file.read(size)
        if len(block) != size or file.read(4) != 2 * LINE.encode():
            raise ValueError(f"the record at {position} is cut short")
        yield position, headers, block


def _id(urn: str | None) -> int | None:
    return int(urn.removeprefix("<urn:record:").removesuffix(">")) if urn else None


def _place(row: dict) -> tuple:
    """What captures are ordered by."""
    return row["url_key"], row["captured"], row["record_id"] is not None, row["record_id"] or 0, row["archive"], row["position"]


def run_of(path: str, archive: bytes) -> list[dict]:
    """The captures of an archive in order."""
    found = []
    for position, headers, block in records(archive):
        size, digest = len(block), hashlib.sha256(block).hexdigest()
        said = int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha256:")
        if headers["WARC-Type"] == "revisit":
            size, digest = said
        elif said != (size, digest):
            raise ValueError(f"{path}: the payload at {position} isn't what its record says")
        found.append(
            dict(
                url_key=url_key(headers.get("WARC-Target-URI", "")),
                captured=headers.get("WARC-Date", ""),
                record_id=_id(headers.get("WARC-Record-ID")),
                archive=path.rpartition("/")[2],
                position=position,
                record_type=headers["WARC-Type"],
                payload_bytes=size,
                payload_digest=digest,
                refers_to=_id(headers.get("WARC-Refers-To")),
            )
        )
    return sorted(found, key=_place)


class LoserTree:
    """Merges sorted sequences of keys: each inner node keeps the loser of its match, the winner goes up."""

    def __init__(self, sequences: list[list]) -> None:
        self.sequences, self.at = sequences, [0] * len(sequences)
        self.size = max(1, len(sequences))
        self.losers = [-1] * self.size
        self.winner = self._play(1)

    def _beats(self, a: int, b: int) -> bool:
        """Whether sequence ``a`` is to give its key before ``b``; those that are used up lose."""
        if a < 0 or self.at[a] >= len(self.sequences[a]):
            return False
        if b < 0 or self.at[b] >= len(self.sequences[b]):
            return True
        return (self.sequences[a][self.at[a]], a) < (self.sequences[b][self.at[b]], b)

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size if node - self.size < len(self.sequences) else -1
        left, right = self._play(2 * node), self._play(2 * node + 1)
        won, lost = (left, right) if self._beats(left, right) else (right, left)
        self.losers[node] = lost
        return won

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """Number of the sequence and place in it, of each key in order."""
        while self.winner >= 0 and self.at[self.winner] < len(self.sequences[self.winner]):
            won = self.winner
            yield won, self.at[won]
            self.at[won] += 1
            node = (won + self.size) // 2
            while node >= 1:
                if self._beats(self.losers[node], won):
                    won, self.losers[node] = self.losers[node], won
                node //= 2
            self.winner = won


def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The captures of a range in order. Parts of runs come mixed, but each run's in its order: where a key is smaller
    than the one before of its run, a new sequence begins."""
    sequences: list[list[tuple]] = []
    rows: list[list[dict]] = []
    open_ones: dict[str, int] = {}
    for batch in batches:
        for row in batch.to_pylist():
            key, number = _place(row), open_ones.get(row["archive"], -1)
            if number < 0 or key < sequences[number][-1]:
                number = open_ones[row["archive"]] = len(sequences)
                sequences.append([])
                rows.append([])
            sequences[number].append(key)
            rows[number].append(row)
    ordered = [rows[number][place] for number, place in LoserTree(sequences)]
    for start in range(0, len(ordered), 10_000):
        yield pa.RecordBatch.from_pylist(ordered[start : start + 10_000], ARROW_SCHEMA)


def capture_index(spark: SparkSession, archives: str) -> DataFrame:
    """The captures of all archives of a folder in the order of URL key and time."""
    files = spark.read.format("binaryFile").load(archives).where("length > 0").select("path", "content")

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                yield pa.RecordBatch.from_pylist(run_of(path, content.as_py()), ARROW_SCHEMA)

    stored = materialise(files.mapInArrow(runs, INDEX_SCHEMA), "warc-runs")
    ranges = stored.count() // RANGE_CAPTURES + 1
    return stored.repartitionByRange(ranges, "url_key", "captured", "record_id").mapInArrow(merged, INDEX_SCHEMA)
