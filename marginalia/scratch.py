"""Tables in the folder that the driver and all executors share.

The cluster names it in ``spark.checkpoint.dir``. Only on one machine (a local master) may a
temporary folder take its place. A session's tables lie in one folder there, which goes when the
session's JVM ends, or with ``clear``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder; a cluster that names none is an error, as executors would write to
    disks of their own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="marginalia-")
    return _LOCAL[app]


def folder(spark: SparkSession) -> str:
    """The folder of this session's tables."""
    return f"{shared_dir(spark)}/marginalia-{spark.sparkContext.applicationId}"


def place(spark: SparkSession, name: str) -> str:
    """A new path in the session's folder."""
    whole = folder(spark)
    path, files = _handle(spark, whole)
    files.deleteOnExit(path)
    return f"{whole}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """``df`` written as a table in the shared folder and read again: the lineage ends here, so a
    lost executor costs a reread and not a recomputation."""
    path = place(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes tables that ``cut`` wrote and that no later step reads."""
    for df in tables:
        path, files = _handle(df.sparkSession, df._cut_path)
        files.delete(path, True)


def clear(spark: SparkSession) -> None:
    """Deletes all tables of the session; results that were not read yet are lost."""
    path, files = _handle(spark, folder(spark))
    files.delete(path, True)


def _handle(spark: SparkSession, where: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())
