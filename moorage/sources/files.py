"""File manifests: which files there are, and what content they have."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from moorage.functions.csv_text import ends_in_quotes, first_record
from moorage.functions.paths import decoded_uri, file_date, glob_escaped, merchant, relative_path, whole_match
from moorage.session import materialise

# Larger files are never taken into memory: their content is hashed in splits.
MAX_CONTENT_BYTES = 128 * 1024 * 1024

EMPTY_CONTENT = "d41d8cd98f00b204e9800998ecf8427e"  # MD5 of no bytes
COMPRESSED = r"(?i)\.(gz|gzip|bz2|deflate|lz4|snappy|zst|xz)$"
UNSPLIT = r"(?i)\.(gz|gzip|deflate|lz4|snappy|zst|xz)$"  # bz2 is read in splits


def list_files(
    spark: SparkSession,
    root: str | list[str],
    pattern: str | None = None,
    glob: str | None = None,
    base: str | None = None,
    fingerprint: str = "content",
    max_content_bytes: int = MAX_CONTENT_BYTES,
    encoding: str = "UTF-8",
    include_empty: bool = True,
    where: Column | None = None,
) -> DataFrame:
    """Manifest of the files below ``root``, one row each.

    ``pattern`` must match the whole relative path. It is applied to file metadata, so files it excludes
    are not opened. ``fingerprint="content"`` hashes the bytes, and takes the header record from the same
    read; ``"listing"`` hashes length and time of change and opens nothing. The hash of a file beyond
    ``max_content_bytes`` is one of its lines instead of its bytes. ``header`` is NULL where the content
    was not read. ``where`` is a condition on path, date and merchant.
    """
    if fingerprint not in ("content", "listing"):
        raise ValueError(f"unknown fingerprint {fingerprint!r}")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(root)
    uri = F.col("_metadata.file_path")
    if pattern:
        files = files.where(whole_match(relative_path(decoded_uri(uri), base), pattern))

    def rows(part: DataFrame, content_hash: Column, header: Column) -> DataFrame:
        return part.select(
            decoded_uri(uri).alias("full_path"),
            uri.alias("uri"),
            "length",
            content_hash.alias("content_hash"),
            header.alias("header"),
            F.col("modificationTime").alias("modified"),
            F.lit(None).cast("boolean").alias("unclosed"),
        )

    by_listing = F.md5(
        F.concat_ws(":", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string"))
    )
    no_header = F.lit(None).cast("string")
    if fingerprint == "listing":
        found = rows(files, by_listing, no_header)
    else:
        readable = ~decoded_uri(uri).rlike(COMPRESSED)
        small = files.where(F.col("length") <= max_content_bytes)
        large = files.where(F.col("length") > max_content_bytes)
        beyond = rows(large, F.md5(F.col("length").cast("string")), no_header)
        wanted = with_attributes(beyond, base)
        wanted = (wanted if where is None else wanted.where(where)).select("full_path")
        paths = [row.full_path for row in wanted.toLocalIterator()]  # file names only
        if paths:
            sums = _line_sums(spark, paths)
            mixed = F.md5(F.concat_ws(":", F.col("length").cast("string"), "sums"))
            beyond = beyond.join(sums, "uri", "left").withColumn("content_hash", mixed).drop("sums")
        found = rows(small, F.md5("content"), F.when(readable, first_record(F.col("content"), encoding))).unionByName(beyond)
    found = with_attributes(found, base)
    if include_empty:
        found = found.unionByName(_zero_byte_files(spark, files, pattern, base, fingerprint))
    return found if where is None else found.where(where)


def with_content(
    spark: SparkSession,
    files: DataFrame,
    max_content_bytes: int = MAX_CONTENT_BYTES,
    encoding: str = "UTF-8",
    sep: str = ",",
) -> DataFrame:
    """Listed files with the hash of their content and, of those small enough, their header record and last quote.

    ``files`` are a stored batch, whose names go through the driver; nothing else is opened.
    """
    names = files.where(F.col("length") > 0).select("full_path", (F.col("length") > max_content_bytes).alias("large"))
    paths: dict[bool, list[str]] = {False: [], True: []}
    for row in names.toLocalIterator():
        paths[row.large].append(row.full_path)
    rows = files.drop("content_hash", "header", "unclosed")
    untold = [F.lit(None).cast("string").alias("header"), F.lit(None).cast("boolean").alias("unclosed")]
    found = [rows.where(F.col("length") == 0).select("*", F.lit(EMPTY_CONTENT).alias("content_hash"), *untold)]
    if paths[False]:
        read = spark.read.format("binaryFile").load([glob_escaped(p) for p in paths[False]])
        readable = ~decoded_uri(F.col("_metadata.file_path")).rlike(COMPRESSED)
        content = read.select(
            F.col("_metadata.file_path").alias("uri"),
            F.md5("content").alias("content_hash"),
            F.when(readable, first_record(F.col("content"), encoding)).alias("header"),
            F.when(readable, ends_in_quotes(F.col("content"), sep, encoding)).alias("unclosed"),
        )
        found.append(rows.join(content, "uri"))
    if paths[True]:
        mixed = F.md5(F.concat_ws(":", F.col("length").cast("string"), "sums"))
        sums = rows.where(F.col("length") > max_content_bytes).join(_line_sums(spark, paths[True]), "uri", "left")
        found.append(sums.select(*rows.columns, mixed.alias("content_hash"), *untold))
    return reduce(DataFrame.unionByName, found).select(*files.columns)


def in_batches(files: DataFrame, size: int) -> Iterator[DataFrame]:
    """Stored files by path, ``size`` at a time; each batch starts behind the last path of the one before."""
    order = F.struct("path", "full_path")
    rest = files
    if (n := files.count()) <= size:
        if n:
            yield files
        return
    while True:
        batch = materialise(rest.orderBy("path", "full_path").limit(size), "batch")
        end = batch.agg(F.count("*").alias("n"), F.max(order).alias("last")).first()
        if end.n:
            yield batch
        if end.n < size:
            return
        behind = (F.col("path") > end.last.path) | ((F.col("path") == end.last.path) & (F.col("full_path") > end.last.full_path))
        rest = files.where((F.col("path") >= end.last.path) & behind)


def _line_sums(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Sums over the lines of each file, read in splits: of their hashes, and of hash times line number.

    Lines are counted within a split; as the sums are linear in the line number, the lines of the splits
    before are added per split, so that the result does not depend on where a file is split. Bytes are
    hashed as they are, of compressed files those of the text.
    """
    lines = spark.read.option("lineSep", "\n").text([glob_escaped(p) for p in paths])
    digest = F.md5("value")
    parts = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("decimal(10,0)").alias(f"h{i}") for i in range(4)]
    lines = lines.select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).cast("decimal(10,0)").alias("at"),
        *parts,
    )
    plain = [F.sum(F.col(f"h{i}").cast("decimal(28,0)")).cast("decimal(28,0)").alias(f"s{i}") for i in range(4)]
    placed = [F.sum(F.col("at") * F.col(f"h{i}")).cast("decimal(38,0)").alias(f"p{i}") for i in range(4)]
    count = F.count("*").cast("decimal(10,0)").alias("n")
    splits = lines.groupBy("uri", "block").agg(F.min("at").alias("first"), count, *plain, *placed)
    before = Window.partitionBy("uri").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)).cast("decimal(12,0)") - F.col("first")
    splits = splits.withColumn("shift", shift.cast("decimal(12,0)"))
    shifted = [F.sum((F.col(f"p{i}") + F.col("shift") * F.col(f"s{i}").cast("decimal(25,0)")).cast("decimal(38,0)")) for i in range(4)]
    whole = [F.sum(f"s{i}") for i in range(4)]
    sums = F.concat_ws(":", *[s.cast("string") for s in (F.sum("n"), *whole, *shifted)])
    return splits.groupBy("uri").agg(sums.alias("sums"))


def with_attributes(files: DataFrame, base: str | None = None) -> DataFrame:
    """Relative path, merchant and date for rows with a ``full_path``."""
    path = relative_path(F.col("full_path"), base)
    return files.withColumn("path", path).select(
        "path",
        "full_path",
        "uri",
        "length",
        "content_hash",
        file_date(path).alias("file_date"),
        merchant(path).alias("merchant"),
        "header",
        *[c for c in ("modified", "unclosed") if c in files.columns],
    )


def _zero_byte_files(
    spark: SparkSession, files: DataFrame, pattern: str | None, base: str | None, fingerprint: str
) -> DataFrame:
    """Files without content: the file index knows them, but the scan leaves them out."""
    listed = spark.createDataFrame([(name,) for name in files.inputFiles()], "uri string")
    uri = F.regexp_replace("uri", "^file:/+", "file:/")
    listed = listed.select(uri.alias("uri"), decoded_uri(F.col("uri")).alias("full_path"))
    if pattern:
        listed = listed.where(whole_match(relative_path(F.col("full_path"), base), pattern))
    scanned = files.select(F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("uri"))
    return with_attributes(
        listed.join(scanned, "uri", "left_anti").select(
            "full_path",
            "uri",
            F.lit(0).cast("bigint").alias("length"),
            F.lit(EMPTY_CONTENT if fingerprint == "content" else None).cast("string").alias("content_hash"),
            F.lit(None).cast("string").alias("header"),
            F.lit(None).cast("timestamp").alias("modified"),
            F.lit(None).cast("boolean").alias("unclosed"),
        ),
        base,
    )


def preview_files(manifest: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` files in path order."""
    return manifest.orderBy("path").limit(n)
