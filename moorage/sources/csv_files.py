"""CSV scans that keep every cell as text and know which file a row came from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from moorage.functions.csv_text import (
    cell_count,
    cells_array,
    cells_schema,
    ends_in_quotes,
    first_record,
    header_names,
    header_problem,
    leaves_quote_open,
    width_class,
)
from moorage.functions.documents import once
from moorage.functions.paths import decoded_uri, glob_escaped
from moorage.session import materialise
from moorage.sources.files import COMPRESSED, MAX_CONTENT_BYTES, UNSPLIT

# Ways to read a file: by one task, in splits with a record per line, in splits with records put together.
WHOLE, LINES, RECORDS = "whole", "lines", "records"
UNCLOSED = "unclosed_quote"

# Encodings whose lines can be told apart by bytes and decoded one by one; files in others are not split.
SPLIT_ENCODINGS = ("UTF-8", "ISO-8859-1")

# Quoted empty text stays empty, an unquoted empty cell is NULL, a doubled quote is a quote.
PARSE = {"quote": '"', "escape": '"', "nullValue": "\u0001", "emptyValue": "", "mode": "PERMISSIVE", "maxColumns": "131072"}
FIRST_WIDTH = 256


def _options(sep: str, encoding: str) -> dict[str, str]:
    return {**PARSE, "sep": sep, "encoding": encoding}


def scan_cells(
    spark: SparkSession,
    paths: list[str],
    width: int,
    skip_header: bool,
    multi_line: bool,
    sep: str = ",",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Rows of CSV files as ``(uri, cells)``, first line of each file left out on request.

    With ``multi_line`` a file is read by one task; without it files are split.
    """
    data = (
        spark.read.schema(cells_schema(width))
        .options(**_options(sep, encoding))
        .options(header=skip_header, enforceSchema=True, multiLine=multi_line)
        .csv([glob_escaped(p) for p in paths])
    )
    return data.select(F.col("_metadata.file_path").alias("uri"), cells_array(width).alias("cells"))


def parse_record(record: Column, width: int, sep: str = ",") -> Column:
    """Cells of the text of one CSV record."""
    parsed = F.from_csv(record, cells_schema(width), {**PARSE, "sep": sep})
    cells = once(parsed, lambda row: F.array(*[row[f"c{i}"] for i in range(1, width + 1)]))
    return F.when(record.isNotNull() & (record != ""), cells)


def _split_lines(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """Lines of files read in splits: ``uri``, where the split starts, place of the line in it, text."""
    lines = spark.read.option("lineSep", "\n").text([glob_escaped(p) for p in paths])
    # the text source gives the bytes as they are, whatever its option says
    value = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    return lines.select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        value.alias("value"),
    )


def _state_after(start: Column, fixed: Column, flips: Column) -> Column:
    """Inside quotes or not, after lines of which the last with a ``fixed`` outcome is known.

    ``fixed`` has the outcome ``state`` and the flips counted ``at`` that line.
    """
    return (F.coalesce(fixed["state"], start).cast("int") + flips - F.coalesce(fixed["at"], F.lit(0))) % 2 == 1


def _outcomes(sep: str) -> dict[str, Column]:
    """State at the end of a line that starts outside quotes, and of one that starts inside."""
    return {
        "out": leaves_quote_open(F.col("value"), sep),
        "ins": leaves_quote_open(F.concat(F.lit('"'), F.col("value")), sep),
    }


def _quote_states(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is known of the state at lines, and of each split the state at its ``start`` and ``end``.

    Lines that keep the state they start in may be left out.
    """
    so_far = Window.partitionBy("uri", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("flips", F.sum((F.col("out") & ~F.col("ins")).cast("int")).over(so_far))
    fixing = F.when(F.col("out") == F.col("ins"), F.struct(F.col("out").alias("state"), F.col("flips").alias("at")))
    rows = rows.withColumn("fixed", F.last(fixing, ignorenulls=True).over(so_far)).drop("out", "ins")

    # the state at the start of each split, from one row per split
    splits = rows.groupBy("uri", "block").agg(F.max_by(F.struct("flips", "fixed"), "place").alias("end"))
    before = Window.partitionBy("uri").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        "uri", "block", F.col("end.flips").alias("flips"), F.col("end.fixed").alias("fixed")
    ).withColumn("flips_before", F.coalesce(F.sum("flips").over(before), F.lit(0)))
    at_split = F.when(
        F.col("fixed").isNotNull(),
        F.struct(F.col("fixed.state").alias("state"), (F.col("flips_before") + F.col("fixed.at")).alias("at")),
    )
    splits = splits.withColumn("fixed_before", F.last(at_split, ignorenulls=True).over(before)).select(
        "uri",
        "block",
        "flips",
        "fixed",
        _state_after(F.lit(False), F.col("fixed_before"), F.col("flips_before")).alias("start"),
    )
    return rows, splits.withColumn("end", _state_after(F.col("start"), F.col("fixed"), F.col("flips"))).drop("flips", "fixed")


def split_records(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Records of files read in splits, put together where quoted cells hold line breaks.

    A line turns the state at its start (inside quotes or not) into the state at its end: it keeps it,
    flips it, or fixes it whatever it was. The state at any line follows from the last line that fixed it
    and the flips since, which running windows find within a split, and once more over the splits of a
    file. No task ever gets more than the lines of one split. Result: ``uri``, ``block`` and ``nth`` of
    the record, ``record``.
    """
    within = Window.partitionBy("uri", "block").orderBy("place")
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("uri").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows, splits = _quote_states(lines.withColumns(_outcomes(sep)))
    splits = splits.select("uri", "block", "start")

    rows = rows.join(splits, ["uri", "block"])
    rows = rows.withColumn("inside", _state_after(F.col("start"), F.col("fixed"), F.col("flips")))
    begins = ~F.coalesce(F.lag("inside").over(within), F.col("start"))
    rows = rows.withColumn("begins", begins).select("uri", "block", "place", "value", "begins")
    rows = rows.withColumn("nth", F.sum(F.col("begins").cast("int")).over(so_far))
    rows = rows.withColumn("alone", F.col("begins") & F.coalesce(F.lead("begins").over(within), F.lit(False)))
    single = rows.where("alone").select("uri", "block", "nth", F.col("value").alias("record"))

    # lines before the first record of a split belong to the last record of an earlier one
    counts = rows.groupBy("uri", "block").agg(F.max("nth").alias("records"))
    last = F.when(F.col("records") > 0, F.struct(F.col("block").alias("block"), F.col("records").alias("nth")))
    counts = counts.select("uri", "block", F.last(last, ignorenulls=True).over(before).alias("owner"))
    rest = rows.where(~F.col("alone")).join(counts, ["uri", "block"])
    own = F.struct("block", "nth")
    rest = rest.withColumn("owner", F.when(F.col("nth") > 0, own).otherwise(F.col("owner")))
    pieces = F.sort_array(F.collect_list(F.struct("block", "place", "value")))
    joined = rest.groupBy("uri", F.col("owner.block").alias("block"), F.col("owner.nth").alias("nth")).agg(
        F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("record")
    )
    return single.unionByName(joined).withColumn("record", F.rtrim("record", F.lit("\r")))


def scan_split_records(
    spark: SparkSession, paths: list[str], width: int, sep: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """Rows as ``scan_cells`` gives them without the header, of large files with line breaks in cells."""
    records = split_records(_split_lines(spark, paths, encoding), sep)
    records = records.where((F.trim("record") != "") & ~((F.col("block") == 0) & (F.col("nth") == 1)))
    return records.select("uri", parse_record(F.col("record"), width, sep).alias("cells"))


def read_headers(
    spark: SparkSession,
    files: DataFrame,
    sep: str = ",",
    encoding: str = "UTF-8",
    max_columns: int | None = None,
    max_content_bytes: int = MAX_CONTENT_BYTES,
) -> DataFrame:
    """Column names of every file of a manifest, how to read it, and why it cannot be loaded.

    No file is read in full for its first record if there is another way: the record comes from the
    manifest, from the content of a small file, or from the first split of a large one. Headers are parsed
    at the width they have, whatever that is.
    """
    records, scanned = header_records(spark, files, sep, encoding, max_content_bytes)
    records = records.withColumn("width", width_class(cell_count(F.col("record"), sep)))
    widths = sorted(r.width for r in records.select("width").distinct().collect() if r.width is not None)
    parts = [
        records.where(F.col("width") == w).select("uri", parse_record(F.col("record"), w, sep).alias("cells"), "reading", "open")
        for w in widths
    ]
    nothing = F.lit(None).cast("array<string>").alias("cells")
    parts.append(records.where(F.col("width").isNull()).select("uri", nothing, "reading", "open"))
    if scanned is not None:
        parts.append(scanned)
    headers = reduce(DataFrame.unionByName, parts)
    named = headers.select("uri", header_names(F.col("cells")).alias("names"), "reading", "open")
    problem = F.coalesce(header_problem(F.col("names"), max_columns), F.when(F.col("open"), UNCLOSED))
    return named.withColumn("problem", problem).drop("open")


def header_records(
    spark: SparkSession, files: DataFrame, sep: str, encoding: str, max_content_bytes: int, content: bool = True
) -> tuple[DataFrame, DataFrame | None]:
    """First record of each file as text, how to read the file, and whether it ends within quotes.

    Second, cells instead of the record, of the files that only a CSV scan can tell. Without ``content``, small files
    that the manifest tells nothing of are not opened.
    """
    known = files.where(F.col("header").isNotNull() | (F.col("length") == 0))
    unclosed = F.col("unclosed") if "unclosed" in files.columns else F.lit(None).cast("boolean")
    parts = [known.select("uri", F.col("header").alias("record"), F.lit(WHOLE).alias("reading"), unclosed.alias("open"))]
    route = (
        F.when(F.col("full_path").rlike(COMPRESSED) & F.lit(encoding.upper() in SPLIT_ENCODINGS), "split")
        .when(F.col("full_path").rlike(COMPRESSED), "scan")
        .when(F.col("length") <= max_content_bytes, "content")
        .when(F.lit(encoding.upper() not in SPLIT_ENCODINGS), "scan")
        .otherwise("split")
    )
    paths: dict[str, list[str]] = {"scan": [], "content": [], "split": []}
    unknown = files.where(F.col("header").isNull() & (F.col("length") > 0))
    for row in unknown.select("full_path", route.alias("route")).toLocalIterator():  # file names of one batch
        paths[row.route].append(row.full_path)
    if paths["content"] and content:
        parts.append(materialise(_content_headers(spark, paths["content"], sep, encoding), "content-headers"))
    if paths["split"]:
        parts.append(_split_headers(spark, paths["split"], sep, encoding))
    scanned = _scanned_headers(spark, paths["scan"], sep, encoding) if paths["scan"] else None
    return reduce(DataFrame.unionByName, parts), scanned


def way_to_read(files: DataFrame, max_content_bytes: int = MAX_CONTENT_BYTES, encoding: str = "UTF-8") -> Column:
    """How to read files whose lines nobody has looked at."""
    whole = files["full_path"].rlike(UNSPLIT) | (files["length"] <= max_content_bytes)
    return F.when(whole | F.lit(encoding.upper() not in SPLIT_ENCODINGS), WHOLE).otherwise(RECORDS)


def _content_headers(spark: SparkSession, paths: list[str], sep: str, encoding: str) -> DataFrame:
    """Header of files small enough to be taken into memory."""
    content = spark.read.format("binaryFile").load([glob_escaped(p) for p in paths])
    return content.select(
        F.col("_metadata.file_path").alias("uri"),
        first_record(F.col("content"), encoding).alias("record"),
        F.lit(WHOLE).alias("reading"),
        ends_in_quotes(F.col("content"), sep, encoding).alias("open"),
    )


def _split_headers(spark: SparkSession, paths: list[str], sep: str, encoding: str) -> DataFrame:
    """Header of large files, read in splits.

    A scan keeps the first line of each task, if its split starts the file, and lines that change the
    state of quotes. Without a line that leaves a quote open every line is a record and the first one the
    header. In files that have some, records of the first split are put together. The state after the
    last split tells whether a quote is never closed, before any lines are joined.
    """
    first_in_task = F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines = _split_lines(spark, paths, encoding)
    kept = lines.withColumns(_outcomes(sep)).select(
        "uri",
        "block",
        "place",
        "out",
        "ins",
        ((F.col("block") == 0) & first_in_task).alias("first"),
        F.when((F.col("block") == 0) & first_in_task, F.ltrim(F.rtrim("value", F.lit("\r")), F.lit("\ufeff"))).alias("value"),
    )
    kept = materialise(kept.where(F.col("first") | F.col("out") | ~F.col("ins")), "quoted-lines")
    usable = F.col("first") & ~F.col("out") & (F.trim("value") != "")
    gz = decoded_uri(F.col("uri")).rlike(UNSPLIT)
    reading = F.when(gz, WHOLE).when(F.bool_or("out"), RECORDS).otherwise(LINES)
    found = kept.groupBy("uri").agg(F.max(F.when(usable, F.col("value"))).alias("record"), reading.alias("reading"))
    _, splits = _quote_states(kept.select("uri", "block", "place", "out", "ins"))
    ends = splits.groupBy("uri").agg(F.max_by("end", "block").alias("open"))
    found = materialise(found.join(ends, "uri", "left"), "headers")
    complete = found.where(F.col("record").isNotNull())
    done = {r.path for r in complete.select(decoded_uri(F.col("uri")).alias("path")).toLocalIterator()}
    rest = [p for p in paths if p not in done]
    if not rest:
        return complete
    # One long record may begin a file whose quote is never closed: such files are not put together.
    stray = {r.path for r in found.where("open").select(decoded_uri(F.col("uri")).alias("path")).toLocalIterator()}
    start = [p for p in rest if p not in stray]
    parts = [complete, found.where("record IS NULL AND open").select("uri", F.lit('"').alias("record"), "reading", "open")]
    if start:
        first_split = _split_lines(spark, start, encoding).where(F.col("block") == 0)
        records = split_records(first_split, sep).where(F.col("nth") == 1)
        record = F.ltrim("record", F.lit("\ufeff")).alias("record")
        whole = F.when(gz, WHOLE).otherwise(RECORDS).alias("reading")
        parts.append(records.select("uri", record, whole, F.lit(False).alias("open")))
    return reduce(DataFrame.unionByName, parts)


def _scanned_headers(spark: SparkSession, paths: list[str], sep: str, encoding: str) -> DataFrame:
    """Header by a CSV scan, each file read by one task, as its lines can't be told apart by bytes.

    The scan is made wider until no header fills it.
    """
    width = FIRST_WIDTH
    while True:
        rows = scan_cells(spark, paths, width, skip_header=False, multi_line=True, sep=sep, encoding=encoding)
        first = rows.withColumn("at", F.monotonically_increasing_id()).groupBy("uri").agg(F.min_by("cells", "at").alias("cells"))
        found = materialise(first.select("uri", "cells", F.lit(WHOLE).alias("reading"), F.lit(None).cast("boolean").alias("open")), "scanned")
        if width >= int(PARSE["maxColumns"]) or found.where(F.element_at("cells", -1).isNotNull()).isEmpty():
            return found
        width = min(4 * width, int(PARSE["maxColumns"]))
