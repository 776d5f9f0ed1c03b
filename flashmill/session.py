"""Session helpers: shared folder, written intermediate tables, shipping of the package."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; where that is unset a folder of this machine, with a local master only."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = getattr(shared_dir, "own", None)
        if at is None:
            at = shared_dir.own = "file://" + tempfile.mkdtemp(prefix="flashmill-")
    return at.rstrip("/")


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have a path of the shared folder removed when the session's file system is closed."""
    fs, p = _hadoop_path(spark, path)
    fs.deleteOnExit(p)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a query go as soon as it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table into the shared folder and read it back.

    Cuts the lineage: a lost executor costs no recomputation of what is
    written. The files are removed when the session's file system is closed.
    """
    return written(df, name)[0]


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``materialize``, and the table's path for who deletes it before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path), path


class Versions:
    """Numbered states (JSON) of a store in a folder all executors share; the highest complete one is in force.

    A state is created exclusively: of two writers of one number the second
    fails. A file that a dying writer left incomplete is never in force.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def latest(self) -> tuple[int, dict | None]:
        """(the highest number given out, the state in force or none)."""
        fs, p = _hadoop_path(self.spark, self.path)
        if not fs.exists(p):
            return -1, None
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        numbers = sorted((int(n[6:]) for n in names if n.startswith("state-")), reverse=True)
        for n in numbers:
            text = self.spark.read.text(f"{self.path}/state-{n:08d}", wholetext=True).first()
            try:
                return numbers[0], json.loads(text[0])
            except (TypeError, ValueError):
                continue
        return (numbers[0] if numbers else -1), None

    def commit(self, number: int, state: dict) -> None:
        fs, p = _hadoop_path(self.spark, f"{self.path}/state-{number:08d}")
        out = fs.create(p, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make the package importable in the Python workers where they don't see the repository already."""
    if getattr(ship, "done", None) == spark.sparkContext.applicationId:
        return
    ship.done = spark.sparkContext.applicationId
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(":"):
        return
    at = Path(tempfile.mkdtemp(prefix="flashmill-")) / "flashmill.zip"
    with zipfile.ZipFile(at, "w") as z:
        for p in (ROOT / "flashmill").rglob("*.py"):
            z.write(p, p.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(at))
