"""Numbers and documents from text files or table columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.text import split_lines


# What separates numbers, Java's Character.isWhitespace.
NUMBER_SEPARATOR = r"[\t-\r\x1C-\x1F\p{Z}&&[^\u00A0\u2007\u202F]]+"
#: Equal lines numbered in one task.
_TIES = 4096
#: Bytes that a split takes in the broadcast table of line numbers, and the most that is broadcast.
_SPLIT_BYTES, _MAX_BROADCAST_BYTES = 64, 256 << 20


def with_line_ids(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``out BIGINT, <text_col>`` with ids that depend on the lines alone, however the file is split.

    The id is a hash of the line and of its number among the equal lines (which
    one is which makes no difference). It costs one shuffle of the lines,
    combined per task, so a line that fills a third of the file is counted
    before it moves, and its copies are numbered in blocks. Among n different
    lines two get the same id with probability about n**2 / 2**65; files with
    ids of their own need none of this.
    """
    counted = df.where(F.col(text_col).isNotNull()).groupBy(text_col).agg(F.count(F.lit(1)).alias("n"))
    few = counted.where(F.col("n") <= _TIES).select(text_col, F.explode(F.expr("sequence(0L, n - 1)")).alias("tie"))
    block = F.explode(F.expr(f"sequence(0L, (n - 1) div {_TIES})")).alias("block")
    many = counted.where(F.col("n") > _TIES).select(text_col, "n", block).repartition(text_col, "block")
    last = F.least(F.col("n"), (F.col("block") + 1) * _TIES) - 1
    many = many.select(text_col, F.explode(F.sequence(F.col("block") * _TIES, last)).alias("tie"))
    return few.unionAll(many).select(F.xxhash64(text_col, "tie").alias(out), text_col)


def numbered_lines(spark: SparkSession, path: str, out: str = "line_no") -> DataFrame:
    """The lines of a text file or folder with their numbers from 0 on: ``out BIGINT, value STRING``.

    Files count in the order of their paths. The number depends on the files
    alone, however Spark splits them, and no text is shuffled: the splits' line
    counts are summed up in file order (one row a split), and a line's number
    is the sum before its split plus its place in it. The files are read twice,
    once to count. The sums are broadcast while the splits, estimated from the
    files' sizes, stay under a bound; beyond it they are joined in a shuffle.
    """
    text = spark.read.text(path)
    # A split's lines come one after the other in one task, so their ids there differ by their places.
    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    text = text.select("value", *where, F.monotonically_increasing_id().alias("at"))
    # Hash and start name a split in 16 bytes.
    split = [F.xxhash64("file", "start").alias("split"), F.col("start")]
    counts = text.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.select(*split, "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rows = text.select("value", *split, "at")
    splits = len(text.inputFiles()) + _bytes(text) // conf_bytes(spark, "spark.sql.files.maxPartitionBytes")
    sums = F.broadcast(sums) if splits * _SPLIT_BYTES <= _MAX_BROADCAST_BYTES else sums.hint("merge")
    return rows.join(sums, ["split", "start"]).select((F.col("before") + F.col("at") - F.col("first")).alias(out), "value")


def _bytes(df: DataFrame) -> int:
    """The size of the files behind a table, by Catalyst's estimate."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def conf_bytes(spark: SparkSession, name: str) -> int:
    """A size in the session's settings, in bytes."""
    return max(1, int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))))


def _number(token):
    """The token as a double; a malformed token fails the query in any SQL
    mode (ANSI casting already fails; without ANSI the cast gives NULL)."""
    x = token.cast("double")
    return F.when(x.isNull(), F.raise_error(F.concat(F.lit("not a number: "), token))).otherwise(x)


def parse_numbers(df: DataFrame, text_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Whitespace-separated numbers of a text column, one row per number.

    Returns ``keep..., pos INT, x DOUBLE`` (``pos`` counts from 0 within the
    row). A malformed token fails the query under ANSI casting, as
    ``Double.parseDouble`` throws. Rows with a NULL text give no numbers.
    """
    tokens = F.filter(F.split(F.col(text_col), NUMBER_SEPARATOR, -1), lambda t: t != "")
    return (
        df.where(F.col(text_col).isNotNull())
        .select(*keep, F.posexplode(tokens).alias("pos", "token"))
        .select(*keep, "pos", _number(F.col("token")).alias("x"))
    )


def read_numbers(spark: SparkSession, path: str) -> DataFrame:
    """All numbers of a text file or folder as ``x DOUBLE``."""
    return parse_numbers(spark.read.text(path), "value").select("x")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A line-per-document text file or folder as ``doc_id BIGINT, text STRING``.

    ``doc_id`` is the line's number, the same however the file is split (see :func:`numbered_lines`).
    """
    return numbered_lines(spark, path, "doc_id").withColumnRenamed("value", "text")


def lines(df: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per line of each text: ``keep..., line_no INT, line STRING``.

    Lines end at CR LF, LF or CR; a final terminator opens no further line and
    the empty text has none. NULL texts are dropped.
    """
    return df.where(F.col(text_col).isNotNull()).select(
        *keep, F.posexplode(split_lines(F.col(text_col))).alias("line_no", "line")
    )
