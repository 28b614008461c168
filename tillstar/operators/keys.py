"""Dense surrogate keys without a global window."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstar.session import COMPRESSION, remove_folder, shared_folder

# monotonically_increasing_id keeps the partition number above bit 33.
_ROW_BITS = 33


# Rows of a range that is sorted or grouped in one task, about: few enough to stay in memory.
RANGE_ROWS = 250_000

_OPENED: ContextVar[list[str] | None] = ContextVar("opened", default=None)


def with_scan_position(df: DataFrame, name: str = "_scan_position") -> DataFrame:
    """Number the rows of a file scan, so that exact copies can be told apart.

    Call it on a table scan with at most filters in between: file splits do not change when
    a task is retried, so the number of a row does not either.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def stored_once(df: DataFrame, label: str) -> DataFrame:
    """Write a DataFrame that several later steps need to the shared folder and read it back.

    Later steps then prune columns and push filters into the stored copy, and a lost
    executor does not bring the computation before it back.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=COMPRESSION)
    opened = _OPENED.get()
    if opened is not None:
        opened.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def released_after(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that ``stored_once`` writes inside, at the end. Results that read them must have been
    written elsewhere by then."""
    opened: list[str] = []
    token = _OPENED.set(opened)
    try:
        yield
    finally:
        _OPENED.reset(token)
        for path in opened:
            remove_folder(spark, path)


def ranges_for(spark: SparkSession, rows: int) -> int | None:
    """Number of ranges for so many rows; None where there are no more than tasks that run at once, which the session may settle."""
    wanted = -(-rows // RANGE_ROWS)
    return wanted if wanted > spark.sparkContext.defaultParallelism else None


def with_keys(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    start: Column | int = 1,
    partitions: int | None = None,
    store_first: bool = False,
) -> DataFrame:
    """Add ``key`` = start, start+1, ... following ``order_by`` over the whole DataFrame.

    Rows are range-partitioned and sorted once and written to the shared folder together
    with their place (partition, row). One count per partition, a handful of rows, gives the
    offset of each partition; it is broadcast back, so no task sees more than its own range.
    Keys are read off stored places, hence a lost executor cannot renumber rows. Range
    partitioning reads its input twice, for a sample and for the rows; ``store_first`` keeps a costly
    input from being computed twice, and lets ranges be made by the number of rows.
    """
    if store_first:
        df = stored_once(df, "keys")
        partitions = partitions or ranges_for(df.sparkSession, df.count())
    ranged = df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by)
    placed = ranged.sortWithinPartitions(*order_by).withColumn("_place", F.monotonically_increasing_id())
    stored = stored_once(placed, "keys")

    part = F.shiftrightunsigned("_place", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
        # one row per partition, so a single-task window is enough
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    first = F.lit(start) if isinstance(start, int) else start
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_offset") + row + first).cast("bigint").alias(key), *df.columns)
    )
