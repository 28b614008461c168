"""CSV sources and the staging load."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar import schemas
from tillstar.functions import row_hash
from tillstar.session import modified_paths
from tillstar.sources.records import breaks_in_quotes, records
from tillstar.sources.tables import TableStore

log = logging.getLogger(__name__)
CORRUPT = "_corrupt_record"


def read_source(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Scan one CSV source; columns are found by the names of the header, whatever their order.

    Values may be quoted, with doubled quotes, commas and line breaks in them; empty values are missing. Rows with too few
    or too many values, or with a value that is not of its declared type, keep their text in
    ``_corrupt_record``. Columns that are not declared are left out, a declared one that is missing is an error.
    Files are read in splits. Where a look at the lines finds a quote left open by one, records are put together from lines
    first; else Spark's own reader takes line for line. Part files of a folder all have the same header.
    """
    options = {"header": True, "quote": '"', "escape": '"'}
    header = spark.read.options(multiLine=True, **options).csv(path).columns
    missing = [f.name for f in schemas.SOURCE[name] if f.name not in header]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    texts = T.StructType([T.StructField(c, T.StringType()) for c in (*header, CORRUPT)])
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if breaks_in_quotes(spark, path):
        rows = records(spark, path).filter("number > 0")  # the first one is the header
        fields = ", ".join(f"`{c}` string" for c in texts.names)
        raw = rows.select(F.from_csv("record", fields, {k: str(v) for k, v in options.items() if k != "header"}).alias("r")).select("r.*")
    else:
        raw = spark.read.schema(texts).options(**options).csv(path)
    typed, wrong = [], F.col(CORRUPT).isNotNull()
    for field in schemas.SOURCE[name]:
        text = F.nullif(F.col(f"`{field.name}`"), F.lit(""))
        value = text.try_cast(field.dataType)
        typed.append(value.alias(field.name))
        wrong = wrong | (text.isNotNull() & value.isNull())
    whole = F.coalesce(CORRUPT, F.to_csv(F.struct(*[F.col(f"`{c}`") for c in header])))
    return raw.select(*typed, F.when(wrong, whole).alias(CORRUPT))


def latest_file(spark: SparkSession, folder: str, glob: str) -> str | None:
    """Most recently modified source matching ``glob``; a source may be a file or a folder
    of part files, of which the latest counts. Only names and times are read, by listings."""
    found = modified_paths(spark, f"{folder.rstrip('/')}/{glob}")
    if not found:
        log.warning("no files match %s in %s", glob, folder)
        return None
    return max((when, path) for path, when in found.items())[1]


def load_id_of(when: dt.datetime) -> int:
    return int(when.strftime("%Y%m%d%H%M%S"))


def with_row_hash(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumn("row_hash", row_hash(columns))


def with_audit(df: DataFrame, source_file: str | Column, load_id: int, load_time: dt.datetime) -> DataFrame:
    """Add source file, load time, row hash of the source columns, and load id."""
    columns = [c for c in df.columns if c != CORRUPT]
    name = F.lit(source_file) if isinstance(source_file, str) else source_file
    return with_row_hash(df, columns).withColumns(
        {
            "source_file": name,
            "load_timestamp": F.lit(load_time.isoformat(sep=" ")).cast("timestamp_ntz"),
            "load_id": F.lit(load_id).cast("bigint"),
        }
    )


def audit_record(
    spark: SparkSession,
    *,
    load_id: int,
    table: str,
    source_file: str | None,
    loaded: int,
    rejected: int,
    started: dt.datetime,
    ended: dt.datetime,
    error: str | None = None,
    load_type: str = "FULL",
    loaded_by: str = "system",
) -> DataFrame:
    """One row for the load log, with the true start and end of the load."""
    status = "SUCCESS" if error is None else "FAILED"
    row = (load_id, table, load_type, source_file, loaded, rejected, started, ended, status, error, loaded_by)
    return spark.createDataFrame([row], schemas.AUDIT_LOG)


def load_source(
    store: TableStore, name: str, folder: str, path: str | None = None, now: dt.datetime | None = None
) -> int:
    """Load the latest (or a given) file of one source into its staging table.

    Good rows are appended, malformed rows are counted, and the load log gets a row whether
    the load succeeds or fails.
    """
    spark = store.spark
    started = now or dt.datetime.now()
    load_id = load_id_of(started)
    source: str | None = path
    try:
        source = source or latest_file(spark, folder, schemas.SOURCE_GLOB[name])
        if source is None:
            raise FileNotFoundError(f"no {schemas.SOURCE_GLOB[name]} in {folder}")
        seen = Observation()
        rows = read_source(spark, name, source).observe(
            seen, F.count(F.lit(1)).alias("all"), F.count(CORRUPT).alias("bad")
        )
        good = rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        audited = with_audit(good, source.rstrip("/").rsplit("/", 1)[-1], load_id, started)
        store.append(audited.select(*schemas.STAGING[name].names), name)
        loaded, rejected = seen.get["all"] - seen.get["bad"], seen.get["bad"]
    except Exception as failure:
        entry = audit_record(
            spark, load_id=load_id, table=name, source_file=source, loaded=0, rejected=0,
            started=started, ended=dt.datetime.now(), error=str(failure)[:1000],
        )
        store.append(entry, "stg_audit_log")
        raise
    entry = audit_record(
        spark, load_id=load_id, table=name, source_file=source.rstrip("/").rsplit("/", 1)[-1],
        loaded=loaded, rejected=rejected, started=started, ended=dt.datetime.now(),
    )
    store.append(entry, "stg_audit_log")
    return loaded


def load_all(store: TableStore, folder: str, now: dt.datetime | None = None) -> dict[str, int]:
    """Load all six sources; returns rows per table and their total."""
    counts = {name: load_source(store, name, folder, now=now) for name in schemas.SOURCE}
    counts["total"] = sum(counts.values())
    return counts
