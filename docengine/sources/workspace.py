"""Folders for tables that a later step of the same run reads again."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_base(spark: SparkSession, folder: str | None = None) -> str:
    """A folder that the driver and all executors reach.

    An explicit one, else `spark.checkpoint.dir`, else the session's warehouse.
    """
    return (
        folder
        or spark.conf.get("spark.checkpoint.dir", None)
        or spark.conf.get("spark.sql.warehouse.dir")
    ).rstrip("/")


def hadoop_path(spark: SparkSession, name: str):
    """A path and the file system that it lies in."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put_text(spark: SparkSession, name: str, text: str) -> None:
    """A small file, in place as a whole or not at all; one of that name is replaced."""
    path, fs = hadoop_path(spark, name)
    folder, _, last = name.rpartition("/")
    draft, _ = hadoop_path(spark, f"{folder}/_draft{last}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(path):
        fs.delete(path, False)
    if not fs.rename(draft, path):
        raise OSError(f"{name} could not be put in place")


def get_text(spark: SparkSession, name: str) -> str | None:
    """The text of a small file; null where there is none."""
    path, fs = hadoop_path(spark, name)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def folders(spark: SparkSession, name: str) -> list[str]:
    """Names of the folders right below a folder, if it is there."""
    path, fs = hadoop_path(spark, name)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())


def delete(spark: SparkSession, name: str) -> None:
    path, fs = hadoop_path(spark, name)
    fs.delete(path, True)


class RunFolder:
    """Parquet tables of one run, in a folder of their own below the shared base.

    A table cuts lineage: a lost executor costs what it was computing, not what is written.
    `drop` removes a table as soon as nothing reads it; the rest goes when the session ends,
    as the result handed out may still be read.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        app = spark.sparkContext.applicationId
        self.path = f"{shared_base(spark, folder)}/docengine-{app}-{uuid.uuid4().hex}"
        path, fs = hadoop_path(spark, self.path)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """The table as written and read again.

        Shuffle files of the steps before stay on the executors' disks until the driver
        collects its garbage; a call now frees them before the next step adds its own.
        """
        df.write.parquet(f"{self.path}/{name}")
        self.spark.sparkContext._jvm.System.gc()
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            path, fs = hadoop_path(self.spark, f"{self.path}/{name}")
            fs.delete(path, True)
