"""Tables that cut lineage: written to the folder that every executor shares."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where it is unset a local default in local mode, else an error."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named.rstrip("/") if named else "file:///tmp/checkpoints/plumbline"


def stored(df: DataFrame, name: str = "t") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Survives lost executors (unlike a cache or a local checkpoint), is compressed, and later
    plans start from a file scan with known sizes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    return out


def drop_stored(df: DataFrame) -> None:
    """Remove a table made by :func:`stored` that no later plan reads."""
    spark = df.sparkSession
    root = shared_dir(spark)
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if folder.startswith(root.replace("file://", "file:")) or folder.startswith(root):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_KEPT: dict[tuple[str, str, str], tuple[tuple, DataFrame]] = {}


def _state(spark: SparkSession, folder: str) -> tuple:
    """Names, times and lengths of a folder's tables."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return tuple(sorted((f.getPath().getName(), f.getModificationTime(), f.getLen()) for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)))


def once(spark: SparkSession, folder: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` derives from a folder's tables, stored for all plans of the application; made anew when the tables change."""
    key, now = (name, spark.sparkContext.applicationId, folder), _state(spark, folder)
    if key not in _KEPT or _KEPT[key][0] != now:
        if key in _KEPT:
            drop_stored(_KEPT[key][1])
        _KEPT[key] = now, stored(make(), name)
    return _KEPT[key][1]


def forget() -> None:
    """Remove what :func:`once` keeps."""
    while _KEPT:
        drop_stored(_KEPT.popitem()[1][1])
