"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Codec of stored tables. Hashes and padded ids, which fill much of them, take about half of what snappy makes of them.
COMPRESSION = "zstd"

# Set on sessions this package creates itself (tests, bench). A session handed in by a
# caller keeps its own settings.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", app: str = "tillstar", memory: str = "8g") -> SparkSession:
    partitions = str(cores) if str(cores).isdigit() else "8"
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster such a folder
    would live on one machine and its contents would be lost with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillstar-"))
        configured = spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate rows, on whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if it is not there."""
    path, files = _file_system(spark, folder)
    try:
        return [status.getPath().getName() for status in files.listStatus(path)]
    except Py4JJavaError as failure:
        if "FileNotFoundException" in str(failure.java_exception):
            return []
        raise


def file_text(spark: SparkSession, file: str) -> str | None:
    """The text of a small file, None if it is not there."""
    path, files = _file_system(spark, file)
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, file: str, text: str) -> bool:
    """Let a small file appear whole under a new name; False if that name is taken."""
    path, files = _file_system(spark, file)
    draft, _ = _file_system(spark, f"{file}.{uuid.uuid4().hex}.draft")
    out = files.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not files.exists(path) and files.rename(draft, path):
        return True
    files.delete(draft, False)
    return False


def modified_paths(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Paths that match a glob with their time of modification; of a folder the latest of its visible files, without any it is left out."""
    path, files = _file_system(spark, pattern)
    found = {}
    for status in files.globStatus(path) or ():
        times = [status.getModificationTime()]
        if status.isDirectory():
            times = [s.getModificationTime() for s in files.listStatus(status.getPath())
                     if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
        if times:
            found[status.getPath().toString()] = max(times)
    return found
