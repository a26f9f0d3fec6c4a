"""Source files: many CSV files at once, each read by its own header line."""

from __future__ import annotations

import csv
import os
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from patronlens import schemas as S
from patronlens.staging import stage

HEADERS = 1000  # different header lines of one source
RECORD_LINES = 10_000

_BAD = "_malformed"
_CSV = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}


def _extension(path: str) -> str:
    return os.path.splitext(path.rstrip("/"))[1].lower()


def _text(value: Column, encoding: str) -> Column:
    return F.decode(value.cast("binary"), encoding)


# What a line does to a reader that begins it outside or inside of a quoted field. A quote
# opens a field only at its beginning; inside of one a doubled quote stands for itself.
_FIELDS = r'(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|),)*+'
_OPENS = rf'\A{_FIELDS}"(?:[^"]++|"")*+\z'  # begins outside, ends inside
_CLOSES = r'\A(?:[^"]++|"")*+"(?!")[^,]*+(?:,|\z)'  # begins inside, leaves the field
_REST = r'\A(?:[^"]++|"")*+"(?!")[^,]*+,?'


def _single_quote(text: Column) -> Column:
    """One quote in the line, and no more: what it does needs no pattern."""
    quote = F.lit('"')
    return F.position(quote, text, F.position(quote, text) + 1) == 0


def _opens(text: Column) -> Column:
    """Whether a line that begins outside of a quoted field ends inside of one."""
    return (F.when(~text.contains('"'), False)
            .when(_single_quote(text), text.startswith('"') | text.contains(',"'))
            .otherwise(text.rlike(_OPENS)))


def _effect(line: str) -> list[Column]:
    """`set_to`: the state after the line where it does not depend on the one before (0 outside,
    1 inside of a quoted field), and `turns`: 1 if the line exchanges the two."""
    text = F.col(line)
    from_outside = _opens(text).cast("int")
    from_inside = (F.when(~text.contains('"'), 1).when(_single_quote(text), 0)
                   .when(~text.rlike(_CLOSES), 1)
                   .otherwise(F.regexp_replace(text, _REST, "").rlike(_OPENS).cast("int")))
    return [F.when(from_outside == from_inside, from_outside).alias("set_to"),
            (from_outside > from_inside).cast("int").alias("turns")]


def _with_states(rows: DataFrame, parts: Sequence[str], order: Sequence[str],
                 prefix: str) -> DataFrame:
    """`rows` with what all rows before each in its part do: `{prefix}set`, the state that the
    last one sets, if one does, and `{prefix}odd`, 1 if an odd number of them has exchanged the
    states since."""
    so_far = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_turned", F.coalesce(F.sum("turns").over(so_far), F.lit(0)))
    rows = rows.withColumn("_last", F.last(F.when(  # both numbers in one
        F.col("set_to").isNotNull(), F.col("_turned") * 2 + F.col("set_to")), True).over(so_far))
    return rows.withColumns({
        f"{prefix}set": F.col("_last").bitwiseAND(1).cast("int"),
        f"{prefix}odd": (F.col("_turned") - F.coalesce(F.shiftright("_last", 1), F.lit(0)))
        .bitwiseAND(1).cast("int")}).drop("_turned", "_last")


def _state(prefix: str, begin: Column) -> Column:
    """The state before a row, 0 or 1, from that before its part."""
    return F.coalesce(F.col(f"{prefix}set"), begin).bitwiseXOR(F.col(f"{prefix}odd"))


def _records(lines: DataFrame) -> DataFrame:
    """Records of files that have quoted line breaks: `lines` (file, block, at, line) with
    continued lines put together (file, line), and `unclosed` for a record that its file does
    not end.

    Every block of a file numbers its records for both states it may begin in, in one pass; a
    scan over the blocks, one row each, tells the state, so records across the border of blocks
    are found without reading a file in one task."""
    block = ("file", "block")
    within = Window.partitionBy(*block).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    own = _with_states(lines.select("*", *_effect("line")), block, ["at"], "own_")
    own = own.withColumns({f"inside{b}": _state("own_", F.lit(b)) for b in (0, 1)})
    own = own.withColumns({f"open{b}": F.coalesce(
        "set_to", F.col(f"inside{b}").bitwiseXOR(F.col("turns"))) for b in (0, 1)})
    lines = stage(own.withColumns({
        f"number{b}": F.sum(1 - F.col(f"inside{b}")).over(within).cast("int") for b in (0, 1)}).drop(
        "set_to", "turns", "own_set", "own_odd"), "csv-lines")
    ends = lines.groupBy(*block).agg(
        F.max(F.shiftleft("at", 2) + F.col("open0") * 2 + F.col("open1")).alias("end"),
        F.max("number0").alias("starts0"), F.max("number1").alias("starts1"))
    end0, end1 = F.shiftright("end", 1).bitwiseAND(1).cast("int"), F.col("end").bitwiseAND(1).cast("int")
    ends = ends.withColumns({"set_to": F.when(end0 == end1, end0), "turns": (end0 > end1).cast("int")})
    blocks = _with_states(ends, ["file"], ["block"], "file_").withColumn("begin", _state("file_", F.lit(0)))
    blocks = blocks.withColumn("starts", F.when(F.col("begin") == 0, F.col("starts0")).otherwise(
        F.col("starts1")))
    # a block's first lines may belong to the last record begun in a block before it
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stage(blocks.withColumn("carried", F.last(F.when(
        F.col("starts") > 0, F.struct("block", F.col("starts").alias("number"))), True).over(before))
        .select(*block, "begin", "starts", "carried"), "csv-blocks")
    known = lines.join(F.broadcast(blocks), list(block)).select(  # one row per block
        *block, "at", "line", "starts", "carried",
        *[F.when(F.col("begin") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1")).alias(c)
          for c in ("inside", "open", "number")])
    single = known.filter("inside = 0 AND open = 0")
    parts = known.filter("inside = 1 OR open = 1").withColumn(
        "record", F.when(F.col("number") > 0, F.struct("block", "number")).otherwise(F.col("carried")))
    stray = _long_records(parts)
    out = single.select("file", "line", F.lit(False).alias("unclosed"))
    if not stray.isEmpty():
        out = out.unionByName(parts.join(stray, ["file", "record"]).select(
            "file", "line", F.lit(True).alias("unclosed")))
        parts = parts.join(stray, ["file", "record"], "left_anti")
    return out.unionByName(
        # the number first: Spark's sort compares the beginning of a key before the rest
        parts.groupBy(F.col("record.number").alias("number"), "file", "record").agg(
            F.sort_array(F.collect_list(F.struct("block", "at", "line", "open"))).alias("of"))
        .select("file", F.array_join(F.col("of.line"), "\n").alias("line"),
                (F.element_at("of.open", -1) == 1).alias("unclosed")))


def _long_records(parts: DataFrame) -> DataFrame:
    """(file, record) of those with more than RECORD_LINES lines, staged. Many records are
    counted together first, but for those that may lie in several blocks; only where there are
    that many lines are they told apart."""
    several = (F.col("number") == 0) | (F.col("number") == F.col("starts"))
    some = F.when(several, F.col("record")).otherwise(F.struct(
        "block", (-1 - F.shiftright("number", 8)).alias("number")))
    counted = parts.withColumn("some", some)
    many = counted.groupBy("file", "some").agg(F.count(F.lit(1)).alias("lines")).filter(
        F.col("lines") > RECORD_LINES).select("file", "some")
    many = stage(many, "csv-many")
    return stage(counted.join(many, ["file", "some"], "left_semi").groupBy("file", "record").agg(
        F.count(F.lit(1)).alias("lines")).filter(F.col("lines") > RECORD_LINES).select(
        "file", "record"), "csv-stray")


def _held(df: DataFrame, keep: Sequence[str], columns: Iterable[Column]) -> DataFrame:
    """`keep` and more columns, made by a generator of one row: filters and projections above
    read the results, none of them computes them again."""
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))


def _parsed(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Every record with its columns by name (null where its file has no such column), and in
    `_malformed` the record itself if it has too few or too many fields or an open quote.

    "auto" takes a file as UTF-8 unless one of its lines is not valid UTF-8, then as latin-1.
    A first scan finds each file's header line, encoding and whether any line leaves a quote
    open; the second one reads the records, whatever the number of headers: a file's header
    says at which place a name stands."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at"),
        F.col("_metadata.file_block_start").alias("block"))
    files = raw.groupBy("file").agg(
        F.min_by("value", F.struct("block", "at")).alias("first"),
        F.max(~F.is_valid_utf8("value")).alias("latin"),
        F.max(_opens(F.col("value"))).alias("breaks"))

    def decoded(value: str) -> Column:
        found = (_text(F.col(value), encoding) if encoding != "auto" else
                 F.when(F.col("latin"), _text(F.col(value), "ISO-8859-1")).otherwise(F.col(value)))
        return F.ltrim(found, F.lit("\ufeff"))

    files = stage(files.select("file", "latin", "breaks", decoded("first").alias("header")), "csv-files")
    found = [r.header for r in files.select("header").distinct().limit(HEADERS + 1).collect()]
    if len(found) > HEADERS:
        raise ValueError(f"more than {HEADERS} different headers: do all files have one?")
    headers = {h: [n.strip() for n in next(csv.reader([h]))] for h in sorted(found)}
    for header, own in headers.items():
        if len(set(own)) != len(own):
            raise ValueError(f"repeated column in header: {header}")
    names = list(dict.fromkeys(n for own in headers.values() for n in own))
    if not names:
        return spark.createDataFrame([], f"file string, line string, {_BAD} string")
    described = F.broadcast(spark.createDataFrame(  # at most HEADERS rows
        list(headers.items()), "header string, names array<string>"))
    files = stage(files.join(described, "header").withColumn(
        "id", F.monotonically_increasing_id()), "csv-named")  # joined by its real size
    lines = raw.join(files, "file").withColumn("line", decoded("value"))
    lines = lines.filter(F.col("line") != F.col("header"))
    described = ("file", "header", "names", "line", "unclosed")
    records = lines.filter(~F.col("breaks")).withColumn("unclosed", F.lit(False)).select(*described)
    if not files.filter("breaks").isEmpty():  # what all lines of a file share stays behind
        own = lines.filter("breaks").select(F.col("id").alias("file"), "block", "at", "line")
        records = records.unionByName(_records(own).withColumnRenamed("file", "id").join(
            files, "id").select(*described))
    records = records.filter(F.trim("line") != "")
    widths = sorted({len(own) for own in headers.values()})  # one parse for each width
    rows = {}
    for width in widths:
        schema = ", ".join([*(f"c{i} STRING" for i in range(width)), f"{_BAD} STRING"])
        # null for the header line, so that nothing ever reads it as data, whatever comes first
        fits = (F.size("names") == width) & (F.col("line") != F.col("header"))
        rows[width] = F.when(fits, F.from_csv("line", schema, _CSV)).alias(f"w{width}")
    parsed = _held(records, ["file", "line", "names", "unclosed"], rows.values())
    row = F.coalesce(*[F.when(F.col(f"w{w}").isNotNull(), F.struct(
        F.col(f"w{w}")[_BAD].alias(_BAD),
        F.array(*[F.col(f"w{w}")[f"c{i}"] for i in range(w)]).alias("fields"))) for w in widths])
    out = _held(parsed, ["file", "line", "names", "unclosed"], [row.alias("row")])
    return out.select("file", "line", F.when(F.col("unclosed"), F.col("line"))
                      .otherwise(F.col(f"row.{_BAD}")).alias(_BAD),
                      *[F.get("row.fields", F.array_position("names", n).cast("int") - 1).alias(n)
                        for n in names])


def extract_csv(spark: SparkSession, path: str, encoding: str = "auto") -> DataFrame:
    """The well-formed lines of all files, all columns as text and found by their names in
    each file's own header; missing markers are null. See `rejected_lines` for the others.
    Quoted fields may hold line breaks; what stands between two quotes more than RECORD_LINES
    lines apart is taken for the work of a stray quote and rejected line by line."""
    parsed = _parsed(spark, path, encoding)
    names = [c for c in parsed.columns if c not in ("file", "line", _BAD)]
    good = F.col(_BAD).isNull()
    return _held(parsed.filter(good), [], [
        F.when(good & ~F.col(f"`{c}`").isin(*S.MISSING_TEXTS), F.col(f"`{c}`")).alias(c)
        for c in names])


def rejected_lines(spark: SparkSession, path: str, encoding: str = "auto") -> DataFrame:
    """(file, line) of records whose number of fields is not that of their file's header, or
    whose last quote is never closed."""
    return _parsed(spark, path, encoding).filter(F.col(_BAD).isNotNull()).select("file", "line")


def extract_data(spark: SparkSession, path: str, encoding: str = "auto") -> DataFrame:
    """Read a source by its extension: .csv (a single file or a glob)."""
    extension = _extension(path)
    if extension == ".csv":
        return extract_csv(spark, path, encoding)
    raise ValueError(f"unsupported file type: {extension!r}")


def validate_schema(df: DataFrame) -> None:
    missing = [c for c in S.REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def export_csv(df: DataFrame, path: str) -> None:
    """CSV files with header, one for each of the result's partitions."""
    df.write.mode("overwrite").option("header", True).csv(path)
