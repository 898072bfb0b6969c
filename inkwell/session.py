"""Session settings, lineage cuts and checked broadcasts shared by all operators."""

from __future__ import annotations

import os
import tempfile

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_MB = 64


def build_session(app: str = "inkwell", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` keys use ``__`` for dots."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Spark sets it from ``spark.checkpoint.dir``. Only a local session may fall back to a
    folder of its own, since a machine-local folder does not survive a lost executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        configured = tempfile.mkdtemp(prefix="inkwell-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and return it with a fresh lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, for heavy work per row on a scan or a cut table.

    Large inputs already have more partitions than cores and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder for a written table."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{os.urandom(6).hex()}")


def hold(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to ``parts`` partitions and kept, computed now, so that joins on these keys know where its rows are."""
    held = df.repartition(parts, *keys).persist(StorageLevel.MEMORY_AND_DISK)
    held.count()
    return held


class Scope:
    """Owns kept and written tables and removes them at its end.

    ``with Scope(spark) as scope:`` a table given to ``keep`` is computed once however often it is read inside;
    one given to ``write`` is written once to the shared checkpoint folder. At the end kept tables leave
    memory and written ones the folder, so results must have been written or collected by then.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.kept: list[DataFrame] = []
        self.paths: list[str] = []
        self.steps: dict[str, str] = {}

    def __enter__(self) -> Scope:
        return self

    def __exit__(self, *_: object) -> None:
        for df in self.kept:
            df.unpersist()
        for path in self.paths:
            self._delete(path)
        self.kept, self.paths, self.steps = [], [], {}

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` in memory, and on the executors' disks where memory is short."""
        self.kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return self.kept[-1]

    def _delete(self, path: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def path(self, name: str) -> str:
        """A new path under the shared checkpoint folder that goes with the scope."""
        self.paths.append(scratch_path(self.spark, name))
        return self.paths[-1]

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def renew(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written as the next state ``name`` of an iteration, whose state before leaves the disk.

        A checkpoint keeps Spark's estimate of its plan's size, and a join multiplies those of its sides. A state joined
        with what was made of it would double the digits of that number in every pass, until
        planning takes longer than the work; the size of a written table is that of its files.
        """
        written = self.write(df, name)
        before, self.steps[name] = self.steps.get(name), self.paths[-1]
        if before is not None:
            self._delete(before)
            self.paths.remove(before)
        return written


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory."""
    total = F.lit(16)
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(column), F.lit(0)) + 16
        elif kind.startswith(("array", "map", "struct")):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 16
        else:
            total = total + 8
    return total.cast("long")


def is_small(df: DataFrame, max_mb: int = SMALL_MB) -> bool:
    """True if the rows of ``df`` take at most ``max_mb`` in memory: one sum, partial on the map side.

    The plan of ``df`` runs for it, so give a written table or a cheap scan.
    """
    return (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= max_mb << 20


def broadcast_if_small(df: DataFrame, max_mb: int = SMALL_MB) -> DataFrame:
    """Mark ``df`` for broadcast if its summed bytes prove it small, else leave the join to Spark."""
    return F.broadcast(df) if is_small(df, max_mb) else df
