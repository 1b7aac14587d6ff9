"""Session helpers: table access, size estimates and tables in the shared folder."""

from __future__ import annotations

import atexit
import math
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_own_dirs: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    It is ``spark.checkpoint.dir`` of the session, else the checkpoint folder set on the context. Where both are unset a temporary folder is made if the executors are threads of this process (master ``local``);
    on a cluster, where each executor would write to a disk of its own, that is a ValueError.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        holder = tempfile.TemporaryDirectory(prefix="nestra-")
        atexit.register(holder.cleanup)
        _own_dirs[app] = "file://" + holder.name
    return _own_dirs[app]


def size_in_bytes(df: DataFrame) -> int:
    """Catalyst's own estimate of a frame's size; for a bare scan the bytes of its files. No job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


#: Above this an estimate only says that Spark does not know the size, as of a frame made from rows.
UNKNOWN = 1 << 53


def pieces(df: DataFrame, bytes_each: int, least: int = 1) -> int:
    """Into how many pieces of about ``bytes_each`` a frame divides; of a frame of unknown size as many as a shuffle has partitions."""
    if (size := size_in_bytes(df)) >= UNKNOWN:
        return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, math.ceil(size / bytes_each))


class Workspace:
    """Tables written to the shared folder: they cut lineage and survive the loss of executors.

    Tables that only loops need are dropped as soon as the next round is written. What a returned frame still reads stays until ``release`` is called or the application ends.
    """

    _open: list["Workspace"] = []

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/nestra-{uuid.uuid4().hex}"
        self._n = 0
        Workspace._open.append(self)
        atexit.register(_remove, spark, self.root)

    def write(self, df: DataFrame, partition_by: Iterable[str] = ()) -> DataFrame:
        """Write ``df`` once and read it back; the schema is given, so reading starts no job."""
        self._n += 1
        path = f"{self.root}/{self._n}"
        writer = df.write.option("compression", "zstd")
        if cols := list(partition_by):
            writer = writer.partitionBy(*cols)
        writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._nestra_path = path
        return out

    def count(self, df: DataFrame, when: str) -> tuple[DataFrame, int]:
        """``write``, and how many of the rows meet ``when``, counted on the way."""
        seen = Observation()
        return self.write(df.observe(seen, F.count_if(F.expr(when)).alias("n"))), seen.get["n"]

    def drop(self, *frames: DataFrame | None) -> None:
        for f in frames:
            if f is not None and (path := getattr(f, "_nestra_path", None)):
                _remove(self.spark, path)


def release(since: int = 0) -> int:
    """Delete the tables behind frames that are no longer read: those of all workspaces but the first ``since``. Returns how many workspaces are left, to be given as ``since`` by the next user."""
    while len(Workspace._open) > since:
        ws = Workspace._open.pop()
        _remove(ws.spark, ws.root)
    return since


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    except Exception:  # the session may have ended already
        pass
