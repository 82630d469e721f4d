"""URL filter by a sorted digest array: memory-mapped 64-bit xxhash keys, binary search, full strings confirmed.

A rule is a host and the beginning of a path, with a verdict. It fits its host and all subdomains if the path starts
with the rule's; of several the longest wins (of equally long ones that with the longer host). Where none fits, the
verdict is ``allow``. Rules that are repeated count once; if they contradict each other, ``block`` wins.

Spark sorts the rules into digest files of at most ``RULES_PER_FILE`` rules, which it then hands to every executor. A
worker maps them into memory, so that all workers of a machine share one copy, and looks up the digests of
``host suffix + path prefix`` of a batch of URLs at once. A digest found is confirmed by the stored string.

Nulls and texts without ``://`` have an empty host and path and no rule. Without rules all is allowed. Very long URLs
cost one digest per label of the host and length of a rule's path. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, functions as F

from moorage.session import new_location

RULES_PER_FILE = 4_000_000
ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path, both empty for null and for texts without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _digest(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode())


def digest_file(keys: list[str], hosts: list[int], blocked: list[bool]) -> bytes:
    """Counts, digests in order, string offsets, host lengths, verdicts, path lengths that occur, strings."""
    digests = np.fromiter(map(_digest, keys), "<u8", len(keys))
    order = np.argsort(digests, kind="stable")
    strings = [keys[i].encode() for i in order]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype("<u8")
    lengths = np.unique([len(k) - h for k, h in zip(keys, hosts, strict=True)]).astype("<u8")
    head = np.array([len(keys), len(lengths)], "<u8")
    flags = np.array(blocked, "u1")[order]
    parts = [head, digests[order], offsets, np.array(hosts, "<u8")[order], lengths, flags]
    return b"".join(p.tobytes() for p in parts) + b"".join(strings)


class Digests:
    """One digest file, mapped into memory."""

    def __init__(self, data: np.ndarray) -> None:
        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            width = np.dtype(kind).itemsize * count
            at += width
            return data[at - width : at].view(kind)

        at = 0
        count, kinds = (int(x) for x in take("<u8", 2))
        self.digests, self.offsets, self.hosts = take("<u8", count), take("<u8", count + 1), take("<u8", count)
        self.path_lengths, self.blocked = {int(x) for x in take("<u8", kinds)}, take("u1", count)
        self.strings = data[at:]

    def probe(self, keys: list[str]) -> dict[str, str]:
        """Verdicts of those keys that are rules."""
        wanted = np.fromiter(map(_digest, keys), "<u8", len(keys))
        places = np.searchsorted(self.digests, wanted)
        near = np.minimum(places, max(0, len(self.digests) - 1))
        found = {}
        for i in np.flatnonzero(self.digests[near] == wanted) if len(self.digests) else ():
            at = int(places[i])
            while at < len(self.digests) and self.digests[at] == wanted[i]:
                if self.strings[int(self.offsets[at]) : int(self.offsets[at + 1])].tobytes() == keys[i].encode():
                    found[keys[i]] = BLOCK if self.blocked[at] else ALLOW
                at += 1
        return found


@lru_cache(maxsize=256)
def mapped(name: str) -> Digests:
    return Digests(np.memmap(SparkFiles.get(name), mode="r"))


def store_rules(rules: DataFrame) -> list[str]:
    """Writes the digest files of rules (host, path, verdict) and gives them to the executors; their names."""
    spark = rules.sparkSession
    keyed = rules.select(F.concat("host", "path").alias("key"), F.length("host").alias("host"), (F.col("verdict") == BLOCK).alias("blocked"))
    once = keyed.groupBy("key", "host").agg(F.max("blocked").alias("blocked"))
    count = max(1, -(-rules.count() // RULES_PER_FILE))

    def build(batch: pa.Table) -> pa.Table:
        data = digest_file(*(batch.column(c).to_pylist() for c in ("key", "host", "blocked")))
        return pa.table({"content": pa.array([data], pa.binary())})

    files = once.groupBy(F.pmod(F.xxhash64("key"), F.lit(count))).applyInArrow(build, "content binary")
    location = new_location(spark, "rules")
    # One row a file: what Spark's text writer adds is a line end after the content, which nothing reads.
    files.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).text(location)
    stored = spark.read.format("binaryFile").load(location).where("length > 0").select("path")
    names = []
    for row in stored.toLocalIterator():
        spark.sparkContext.addFile(row.path)
        names.append(row.path.rpartition("/")[2])
    return names


def candidates(host: str, path: str, lengths: Iterable[int]) -> list[tuple[int, int, str]]:
    """What rules that fit could be, as (length, length of the host, text), the winning one first."""
    labels = host.split(".")
    suffixes = [".".join(labels[i:]) for i in range(len(labels))]
    fitting = [n for n in lengths if n <= len(path)]
    return sorted(((len(s) + n, len(s), s + path[:n]) for s in suffixes for n in fitting), reverse=True)


def judged(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Adds rule and verdict to batches that hold columns host and path."""
    files = [mapped(name) for name in names]
    lengths = sorted(set().union(*(f.path_lengths for f in files)))
    for batch in batches:
        hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
        options = [candidates(h, p, lengths) if h or p else [] for h, p in zip(hosts, paths, strict=True)]
        keys = list({key for option in options for _, _, key in option})
        found: dict[str, str] = {}
        for file in files:
            found.update(file.probe(keys))
        rules = [next((key for _, _, key in option if key in found), None) for option in options]
        verdicts = [ALLOW if rule is None else found[rule] for rule in rules]
        columns = [*batch.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "rule", "verdict"])


def judge_urls(rows: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``keep`` of each row, with host, path, rule and verdict of its URL."""
    names = store_rules(rules)
    host, path = host_and_path(F.col(url))
    parts = rows.select(*[F.col(c) for c in keep], host.alias("host"), path.alias("path"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in parts.schema) + "rule string, verdict string"
    return parts.mapInArrow(lambda batches: judged(batches, names), schema)
