"""Sessions, table access and materialised intermediate tables."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sparkprep")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def staging_root(spark: SparkSession) -> str:
    """The shared folder for intermediate data.

    The session names it in ``spark.checkpoint.dir``. Where that is unset, the warehouse
    serves, which every session has; on a cluster it must not be a local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged"
    if not configured and root.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share; the warehouse is a local one")
    return root.rstrip("/")


def staging_path(spark: SparkSession, label: str) -> str:
    """A new path below :func:`staging_root`; no two calls share one."""
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    if not _STAGED:
        atexit.register(_clear)
    _STAGED[path] = spark
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a read of it.

    For a result that is costly and read several times. Against a cache it survives the
    loss of executors and cuts the lineage; against a checkpoint it is columnar, so later
    passes read only the columns they need. The files go when the application ends, or
    earlier by :func:`unstage`.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_alone(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Write the result of ``make``, and delete what it staged for itself."""
    before = set(_STAGED)
    df = make()
    own = set(_STAGED) - before
    result = stage(df, label)
    for path in own & set(_STAGED):
        delete(df.sparkSession, path)
    return result


def unstage(df: DataFrame) -> None:
    """Delete the files below a result of :func:`stage` that nothing will read again."""
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        delete(df.sparkSession, path)


_STAGED: dict[str, SparkSession] = {}


def _file_system(spark: SparkSession, path: str):
    """The path and its file system, whichever it is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop, system = _file_system(spark, path)
    return system.getFileStatus(hadoop).isDirectory()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder."""
    hadoop, system = _file_system(spark, path)
    system.delete(hadoop, True)
    _STAGED.pop(path, None)


def rename(spark: SparkSession, path: str, target: str) -> None:
    """Give a folder another name, in one step where the file system can; folders above it are made."""
    hadoop, system = _file_system(spark, path)
    place, _ = _file_system(spark, target)
    system.mkdirs(place.getParent())
    if not system.rename(hadoop, place):
        raise OSError(f"{path} could not be renamed to {target}")


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder; none if it does not exist."""
    hadoop, system = _file_system(spark, path)
    return [e.getPath().getName() for e in system.listStatus(hadoop)] if system.exists(hadoop) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file."""
    hadoop, system = _file_system(spark, path)
    out = system.create(hadoop, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """Read a small file."""
    hadoop, system = _file_system(spark, path)
    stream = system.open(hadoop)
    text = bytes(stream.readAllBytes()).decode()
    stream.close()
    return text


def _clear() -> None:
    for path, spark in list(_STAGED.items()):
        if spark.sparkContext._jsc is not None:
            delete(spark, path)
