"""What a session needs before this package runs on its executors, and stage tables."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_ligature_shipped", False):
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="ligature-")) / "ligature.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for p in sorted(here.rglob("*.py")):
            out.write(p, f"{here.name}/{p.relative_to(here)}")
    sc.addPyFile(str(archive))
    sc._ligature_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    sc = spark.sparkContext
    if sc.master == "local" or sc.master.startswith("local["):
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="ligature-"))
        return sc.getCheckpointDir().rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/ligature/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return the written table.

    The written table cuts the lineage, survives lost executors, and is read without a schema scan.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.option("compression", "zstd").mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def freed(spark: SparkSession) -> None:
    """Let Spark delete shuffle files: those of finished queries stay until the driver's heap has given up their plans."""
    spark.sparkContext._jvm.System.gc()


def dropped(df: DataFrame) -> None:
    """Delete a written table that nothing reads any more."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent() if df.inputFiles() else None
    if path is not None:
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """The rows dealt by a hash of the columns to all tasks: few bytes that cost much to work on would be one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def derived(df: DataFrame, keys: list[str], make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``df`` with the columns that ``make`` adds to its ``keys``, made once for equal ones."""
    made = make(spread(df.select(*keys).distinct(), *keys))
    other = made.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in made.columns if c not in keys])
    same = reduce(Column.__and__, [df[k].eqNullSafe(other[f"__{k}"]) for k in keys])
    return df.join(other.hint("merge"), same).drop(*[f"__{k}" for k in keys])


def version(df: DataFrame) -> str:
    """A name for the state of the files that a table is read from: paths, lengths and times of change."""
    spark = df.sparkSession
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = hashlib.sha256()
    for f in sorted(df.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(f)
        status = path.getFileSystem(hadoop).getFileStatus(path)
        out.update(f"{f} {status.getLen()} {status.getModificationTime()}\n".encode())
    return out.hexdigest()[:32]


def written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to the path to its end."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def resumed(spark: SparkSession, name: str, key: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """The stage ``name`` of what ``key`` stands for: read again if it was written to its end before, else built anew.

    Half-written folders are replaced; ``force`` builds in any case, into a folder of its own, and keeps the old one.
    """
    path = f"{shared_dir(spark)}/ligature/{name}-{hashlib.sha256(key.encode()).hexdigest()[:32]}"
    if written(spark, path) and not force:
        return spark.read.parquet(path)
    df = build()
    if force:
        return stage(df, name)
    df.write.option("compression", "zstd").mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
