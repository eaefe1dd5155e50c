"""Session helpers: a local session for tests, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, partitions: int | None = None, app: str = "panelkiln") -> SparkSession:
    """A single-JVM session for tests and the benchmark. Clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="panelkiln-"))
    return context.getCheckpointDir().rstrip("/")


_MADE: list[str] = []


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def clear_stored(spark: SparkSession) -> int:
    """Delete what ``fresh_folder`` and ``stored`` have made in this process, and say how many folders.

    For when their results are no longer read: tables derived from them are gone too.
    """
    gone = 0
    while _MADE:
        gone += delete_folder(spark, _MADE.pop())
    return gone


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whatever store it is in; False where there was none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in whatever store it is in; none where there is no folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []


def rename_folder(spark: SparkSession, source: str, target: str) -> None:
    """Give a whole folder its final name at once, so that readers see all of it or nothing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(source)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(goal.getParent())
    if not system.rename(place, goal):
        raise OSError(f"cannot rename {source} to {target}")


def stored(df: DataFrame, label: str = "stored") -> DataFrame:
    """The same rows, computed once and read from a table in the shared folder afterwards.

    For results that a plan needs several times: Spark would otherwise compute
    them once per use. A lost executor costs nothing, as the table outlives it.
    """
    return _stored_at(df, fresh_folder(df.sparkSession, label))


def _stored_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored tables of a computation that needs them for a while, such as one round of a loop.

    ``clear`` deletes them, so that the shared folder holds what later steps read
    and not what all rounds have written. Call it once no unwritten result depends on them.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stored(self, df: DataFrame, label: str = "scratch") -> DataFrame:
        self.paths.append(fresh_folder(self.spark, label))
        return _stored_at(df, self.paths[-1])

    def clear(self) -> None:
        for path in self.paths:
            delete_folder(self.spark, path)
            if path in _MADE:
                _MADE.remove(path)
        self.paths = []
