"""Where intermediate tables live.

Everything written between steps goes to the shared folder that the session
names in `spark.checkpoint.dir`, so it outlives any executor. Only a local
session without that setting gets a temporary folder.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    base = spark.conf.get(SETTING, None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="corpusloom-")
    spark.conf.set(SETTING, base)
    return base


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it is not there. They are fetched as one
    string, since a call for each of many names takes long; no name has a slash."""
    files, target = _folder(spark, path)
    if not files.exists(target):
        return []
    entries = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(files.listStatus(target))
    text = spark.sparkContext._jvm.org.apache.commons.lang3.ArrayUtils.toString(entries)[1:-1]
    parent = files.makeQualified(target).toString().rstrip("/") + "/"
    return text.removeprefix(parent).split(f",{parent}") if text else []


def is_folder(spark: SparkSession, path: str) -> bool:
    files, target = _folder(spark, path)
    return files.exists(target) and files.getFileStatus(target).isDirectory()


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column, from the folders right below `path`."""
    return [n.split("=", 1)[1] for n in folder_names(spark, path) if n.startswith(f"{column}=")]


def mark(spark: SparkSession, path: str) -> None:
    """Make an empty folder; its name is the message, and it is there or not."""
    files, target = _folder(spark, path)
    files.mkdirs(target)


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _folder(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written and that nobody reads any more."""
    files, target = _folder(spark, path)
    files.delete(target, True)


def remove_each(spark: SparkSession, folder: str, names) -> None:
    """Delete some folders below one folder."""
    files, place = _folder(spark, folder)
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in names:
        files.delete(to_path(place, name), True)


def move_each(spark: SparkSession, folder: str, target: str, names) -> None:
    """Put some folders below `folder` in the places of those of the same names below
    `target`, which may be there or not."""
    files, source = _folder(spark, folder)
    place = _folder(spark, target)[1]
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files.mkdirs(place)
    for name in names:
        new = to_path(place, name)
        files.delete(new, True)
        if not files.rename(to_path(source, name), new):
            raise OSError(f"{folder}/{name} could not be moved to {target}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several later steps read, and read it back.

    A written table outlives executors that come and go, while a cached one would be
    recomputed. It stays in the shared folder; clear that folder after a run.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
