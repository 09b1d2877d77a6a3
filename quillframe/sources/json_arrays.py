"""JSON arrays of any size read in byte ranges: a file is as many tasks as it has blocks."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The column of ``read_json_array`` that holds what is no record.
CORRUPT = "_corrupt_record"
#: Bytes from which a line is not looked at: its file is cut at braces.
LONG_LINE = 16 << 20
#: Objects and arrays inside each other, up to which a line is told to be one record.
NESTED = 16


def _one_record() -> str:
    """A pattern of one object with all brackets inside it paired, up to ``NESTED`` levels; it never goes back."""
    plain, string = r'[^"\\{}\[\]]++', r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    inner = f"(?:{plain}|{string})*+"
    for _ in range(NESTED):
        inner = rf"(?:{plain}|{string}|[{{\[]{inner}[}}\]])*+"
    return rf"\{{{inner}\}}"


#: A line of an array with a record a line: brackets and commas around one object, or around none.
_LINE = rf"(?s)^\s*+\[?\s*+,?\s*+(?:{_one_record()})?\s*+,?\s*+\]?\s*+$"


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The objects of files that hold a JSON array each, in rows of ``schema`` (DDL) and ``_corrupt_record``.

    A first pass tells the files that hold one record on each line, as ``write_json_arrays`` writes them (names and a
    flag a file come to the driver); those are read line by line, without a shuffle.
    All others are cut at every closing brace, so blocks of one file are read by several tasks. Which braces
    end a record depends on the strings and brackets before them: each block is reduced to what it does to
    both possible states at its start, the states of all blocks follow from these few rows, and the pieces
    are joined with the state of their block. Texts are shuffled once, by file and block; a record that
    crosses blocks is put together from its ends alone, two rows a block.

    An empty file or array has no rows. What is no object of ``schema`` is a row with ``_corrupt_record``:
    numbers and strings between the records, objects outside an array, and the last record of a file
    that doesn't end with its bracket, as it may be cut (its text stands there without a last brace). A record must fit into a row, and so must all that
    follows a quote that is never closed. The order of the rows is not that of the file.
    """
    files = [(re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(f)), lines) for f, lines in _by_lines(spark, path).collect()]
    found = [read(spark, own) for read, own in ((_line_records, [f for f, lines in files if lines]), (_cut_records, [f for f, lines in files if not lines])) if own]
    if not found:
        found = [spark.createDataFrame([], "text string, odd boolean")]
    return reduce(DataFrame.unionAll, (_parsed(df, schema) for df in found))


def _parsed(found: DataFrame, schema: str) -> DataFrame:
    """Rows of ``schema`` from the texts of records."""
    text = F.regexp_replace("text", r"^[\s,\[]+", "")
    fields = StructType.fromDDL(schema).fields
    parsed = F.from_json(text, StructType.fromDDL(f"{schema}, {CORRUPT} string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    corrupt = F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in fields), text.alias(CORRUPT))
    rows = found.where(~text.rlike(r"^\]?\s*$"))
    return rows.select(F.when(F.startswith(text, F.lit("{")) & ~F.col("odd"), parsed).otherwise(corrupt).alias("r")).select("r.*")


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The lines of files; those of ``LONG_LINE`` bytes and more are left out, as they may be whole files."""
    return spark.read.option("lineSep", "\n").option("mapreduce.input.linerecordreader.line.maxlength", str(LONG_LINE)).text(paths)


def _by_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, lines) of each file that isn't empty: whether it is an array whose every line is a record. Then no string
    goes over the end of a line, and the depth is one there."""
    line, size, name = F.col("value"), F.col("_metadata.file_size"), F.col("_metadata.file_path")
    blank = ~line.rlike(r"\S")
    at = F.when(~blank, F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))
    opens, closes = line.rlike(r"^\s*+\["), line.rlike(r"\]\s*$")
    rows = _lines(spark, [path]).select(
        name.alias("file"), size.alias("size"), (F.octet_length(line) + 1).alias("bytes"), at.alias("at"), line.rlike(_LINE).alias("fits"), opens.alias("opens"), closes.alias("closes")
    )
    one = lambda c, first: (F.count_if(c) == 1) & first(F.when(F.col(c), F.col("at"))).eqNullSafe(first("at"))
    seen = F.sum("bytes").isin(F.max("size"), F.max("size") + 1)  # no line was left out; the last may lack its end
    read = rows.groupBy("file").agg((seen & F.bool_and("fits") & one("opens", F.min) & one("closes", F.max)).alias("lines"))
    # A file of one long line has no rows here.
    named = spark.read.format("binaryFile").load(path).where("length > 0").select(F.col("_metadata.file_path").alias("file"))
    return named.join(read, "file", "left").select("file", F.coalesce("lines", F.lit(False)).alias("lines"))


def _line_records(spark: SparkSession, files: list[str]) -> DataFrame:
    """(text, odd) of each record of files with a record a line."""
    text = F.rtrim(F.col("value"), F.lit("], \t\r\v\f"))
    return _lines(spark, files).select(text.alias("text"), F.lit(False).alias("odd"))


def _cut_records(spark: SparkSession, files: list[str]) -> DataFrame:
    """(text, odd) of each record of any files."""
    cut = spark.read.option("lineSep", "}").text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("piece"),
    )
    pieces = _with_effects(cut)
    return _records(_with_ends(pieces, _block_states(pieces)))


def _less(text: Column, characters: str) -> Column:
    """How many of the characters a text has."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _depth_change(text: Column) -> Column:
    """Opening less closing brackets outside strings, the brace behind the piece counted too. ``text``
    has no escapes and begins outside a string."""
    outside = F.regexp_replace(text, r'"[^"]*("|$)', "")
    return _less(outside, "{[") - _less(outside, "]") - F.when(_less(text, '"') % 2 == 0, 1).otherwise(0)


def _with_effects(cut: DataFrame) -> DataFrame:
    """Pieces with their ``number`` in the block and what the block did up to and with them: ``flips``, its
    quotes, and the change of depth if it begins outside (``d0``) or inside a string (``d1``)."""
    w = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    plain = F.regexp_replace("piece", r"\\.", "")
    local = cut.withColumns({"quotes": _less(plain, '"'), "out": _depth_change(plain), "within": _depth_change(F.concat(F.lit('"'), plain))})
    run = local.withColumns({"number": F.count("*").over(w), "flips": F.sum("quotes").over(w)})
    even = (F.col("flips") - F.col("quotes")) % 2 == 0
    depths = {"d0": F.sum(F.when(even, F.col("out")).otherwise(F.col("within"))).over(w), "d1": F.sum(F.when(even, F.col("within")).otherwise(F.col("out"))).over(w)}
    return run.withColumns(depths).drop("quotes", "out", "within")


def _block_states(pieces: DataFrame) -> DataFrame:
    """(file, block, inside, depth, last): the state in which each block of a file begins, and the number of
    the file's last piece in its last block; a row a block."""
    blocks = pieces.groupBy("file", "block").agg(F.max("number").alias("n"), *(F.max_by(c, "number").alias(c) for c in ("flips", "d0", "d1")))
    along = Window.partitionBy("file").orderBy("block")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2 == 1
    change = F.when(F.col("inside"), F.col("d1")).otherwise(F.col("d0"))
    last = F.when(F.lead("block").over(along).isNull(), F.col("n"))
    return blocks.withColumns({"inside": inside, "last": last}).withColumn("depth", F.coalesce(F.sum(change).over(before), F.lit(0))).select("file", "block", "inside", "depth", "last")


def _with_ends(pieces: DataFrame, states: DataFrame) -> DataFrame:
    """Pieces with whether a record ends with them, whether that is odd (outside an array, or not closed),
    and ``k``, the number of records that ended in their block before."""
    known = pieces.join(states, ["file", "block"])
    depth = F.col("depth") + F.when(F.col("inside"), F.col("d1")).otherwise(F.col("d0"))
    outside = (F.col("flips") + F.col("inside").cast("int")) % 2 == 0
    final = F.coalesce(F.col("number") == F.col("last"), F.lit(False))
    ended = known.select("file", "block", "number", "piece", (final | (outside & (depth <= 1))).alias("ended"), (final | (depth < 1)).alias("odd"), final.alias("final"))
    w = Window.partitionBy("file", "block").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return ended.withColumn("k", F.coalesce(F.sum(F.col("ended").cast("int")).over(w), F.lit(0)))


def _records(pieces: DataFrame) -> DataFrame:
    """(text, odd) of each record: joined inside blocks first, then along the file what crosses blocks."""

    def joined(df: DataFrame, keys: list[str], order: list[str], text: str) -> DataFrame:
        texts = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("text")))), lambda p: p["text"])
        return df.groupBy(*keys).agg(F.array_join(texts, "").alias("text"), F.bool_or("ended").alias("ended"), F.bool_or(F.col("ended") & F.col("odd")).alias("odd"))

    # The file's last piece has no brace behind it.
    braced = pieces.withColumn("piece", F.when(F.col("final"), F.col("piece")).otherwise(F.concat("piece", F.lit("}"))))
    groups = joined(braced, ["file", "block", "k"], ["number"], "piece")
    inner = (F.col("k") > 0) & F.col("ended")
    along = Window.partitionBy("file").orderBy("block", "k").rowsBetween(Window.unboundedPreceding, -1)
    crossing = groups.where(~inner).withColumn("chain", F.coalesce(F.sum(F.col("ended").cast("int")).over(along), F.lit(0)))
    return groups.where(inner).select("text", "odd").unionAll(joined(crossing, ["file", "chain"], ["block", "k"], "text").select("text", "odd"))


def write_json_arrays(df: DataFrame, path: str, order_by: list[str], files: int = 8) -> None:
    """``df`` as ``files`` JSON arrays with a record a line, written in parallel; the rows of each are in the order of
    ``order_by``, which must tell rows apart and deals them to the files by hash."""
    rows = df.select(F.pmod(F.xxhash64(*order_by), F.lit(files)).cast("int").alias("bucket"), F.lit(0).alias("end"), F.struct(*order_by).alias("at"), F.to_json(F.struct("*")).alias("record"))
    ends = df.sparkSession.range(files).select(F.col("id").cast("int").alias("bucket"), F.lit(1).alias("end"), F.lit(None).cast(rows.schema["at"].dataType).alias("at"), F.lit("]").alias("record"))
    # A running number needs the row before only, so that no file is held in memory.
    first = F.row_number().over(Window.partitionBy("bucket").orderBy("end", "at")) == 1
    before = F.when(first, "[").when(F.col("end") == 0, ",").otherwise("")
    rows.unionAll(ends).select("bucket", F.concat(before, "record").alias("value")).write.partitionBy("bucket").text(path)
