"""Session helpers shared by the tests, the bench and the registered queries."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str, cores: int | str = 8, **conf: str) -> SparkSession:
    """A local session with the settings the engine expects on a cluster as well."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # Recording the call site of every column expression doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local master without that setting gets a folder of its own; a cluster
    without it is an error, because a machine-local folder would lose data.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        _use(spark, named)
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tidemark-")
    _use(spark, made)
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def _use(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def scratch(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path, by the session's Hadoop settings."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none if it is not there."""
    files, place = _folder(spark, path)
    return [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []


def count_files(spark: SparkSession, path: str) -> int:
    """Files below a folder and its folders; none if it is not there."""
    files, place = _folder(spark, path)
    return files.getContentSummary(place).getFileCount() if files.exists(place) else 0


def there(spark: SparkSession, path: str) -> bool:
    files, place = _folder(spark, path)
    return files.exists(place)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; an error if the target is there or the rename fails."""
    files, place = _folder(spark, source)
    if there(spark, target) or not files.rename(place, _folder(spark, target)[1]):
        raise FileExistsError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    files, place = _folder(spark, path)
    files.delete(place, True)
