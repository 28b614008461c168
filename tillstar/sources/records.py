"""Records of CSV files with line breaks in quotes, from lines that many tasks read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A field is quoted (quotes in it are doubled) or starts with neither a quote nor a comma; a quote further on means itself.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"[^,]*+'
_FIELD = rf'(?:{_QUOTED}|[^",][^,]*+|)'
# The whole of a line that begins at a record and leaves no quote open.
_CLOSED_LINE = rf"(?s)^{_FIELD}(?:,{_FIELD})*+$"
# The same for a line that begins within a quoted field.
_CLOSING_LINE = rf'(?s)^[^"]*+(?:""[^"]*+)*+"(?!")[^,]*+(?:,{_FIELD})*+$'


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of files with the file, the block and the place in it that they come from, read by as many tasks as there are splits."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")


def _effects(rows: DataFrame) -> DataFrame:
    """What a line does to an open quote: ``opens`` if it leaves one open that began closed, ``stays`` if it leaves open what began open."""
    quotes = F.col("value").contains('"')
    return rows.withColumns({
        "opens": quotes & ~F.col("value").rlike(_CLOSED_LINE),
        "stays": ~quotes | ~F.col("value").rlike(_CLOSING_LINE),
    })


def breaks_in_quotes(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether a record goes on over a line break: only if some line opens a quote that it does not close."""
    return not _effects(lines(spark, path)).filter("opens").isEmpty()


def _swaps() -> Column:
    return (F.col("opens") & ~F.col("stays")).cast("bigint")


def _fixed() -> Column:
    """The state after a line that does not depend on the state before, else null."""
    return F.when(F.col("opens") == F.col("stays"), F.col("opens"))


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text of each record with its ``file`` and its ``number`` in it from 0, empty lines left out.

    A line either sets whether a quote is open after it, keeps it, or turns it round. So a block is summed up by what
    it does as a whole, the state at its beginning follows from the blocks before it (a row each), and the
    state at each line from the lines of its block. Records are numbered in the same way; a line within
    quotes belongs to the last record that began, maybe in an earlier block. Only records of several lines are put
    together by a shuffle.
    """
    effects = _effects(lines(spark, path))
    inside = Window.partitionBy("file", "block").orderBy("at")
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    before = (
        effects.withColumn("turned", F.coalesce(F.sum(_swaps()).over(upto), F.lit(0)))
        .withColumn("fixed_at", F.when(_fixed().isNotNull(), F.struct(_fixed().alias("open"), F.col("turned").alias("turned"))))
        .withColumn("last", F.last("fixed_at", ignorenulls=True).over(upto)))
    # Turns after the last line that sets the state; without one, turns since the block's beginning.
    rows = before.select(
        "file", "block", "at", "value", "opens", "stays", F.col("last.open").alias("set"),
        ((F.col("turned") - F.coalesce(F.col("last.turned"), F.lit(0))) % 2 == 1).alias("odd"))
    ends = rows.groupBy("file", "block").agg(F.max_by(F.struct("set", "odd", "opens", "stays"), "at").alias("e"))
    after = (  # the same for the block as a whole, its last line included
        ends.select("file", "block", F.when(F.col("e.opens") == F.col("e.stays"), F.col("e.opens")).otherwise(F.col("e.set")).alias("set"),
                    F.when(F.col("e.opens") == F.col("e.stays"), F.lit(False)).otherwise(
                        F.col("e.odd") != (F.col("e.opens") & ~F.col("e.stays"))).alias("odd")))
    # One row for each block of a file, so a file's blocks fit one task.
    blocks = Window.partitionBy("file").orderBy("block")
    earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
    summed = (
        after.withColumn("turns", F.coalesce(F.sum(F.col("odd").cast("bigint")).over(earlier), F.lit(0)))
        .withColumn("own", F.when(F.col("set").isNotNull(), F.struct(
            (F.col("set") != F.col("odd")).alias("open"), (F.col("turns") + F.col("odd").cast("bigint")).alias("turns"))))
        .withColumn("known", F.last("own", ignorenulls=True).over(earlier))
        .select("file", "block", (F.coalesce(F.col("known.open"), F.lit(False)) != (
            (F.col("turns") - F.coalesce(F.col("known.turns"), F.lit(0))) % 2 == 1)).alias("open_at_begin")))
    placed = rows.join(summed, ["file", "block"]).withColumn(
        "open", F.coalesce("set", "open_at_begin") != F.col("odd")).select(
        "file", "block", "at", "value", "open", F.when(F.col("open"), F.col("stays")).otherwise(F.col("opens")).alias("goes_on"))
    begins = (~F.col("open")).cast("bigint")
    counts = placed.groupBy("file", "block").agg(F.sum(begins).alias("begun"))
    first = counts.select("file", "block", F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("first"))
    numbered = (
        placed.withColumn("begun", F.sum(begins).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .join(first, ["file", "block"])
        .select("file", (F.col("first") + F.col("begun") - 1).alias("number"), "block", "at", "value", "open", "goes_on"))
    single = numbered.filter(~F.col("open") & ~F.col("goes_on")).select("file", "number", F.col("value").alias("record"))
    parts = numbered.filter(F.col("open") | F.col("goes_on")).groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("parts"))
    several = parts.select("file", "number", F.array_join(F.col("parts.value"), "\n").alias("record"))
    return single.unionByName(several).withColumn("record", F.regexp_replace("record", r"\r$", "")).filter("record <> ''")
