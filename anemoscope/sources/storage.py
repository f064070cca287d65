"""Driver-side file metadata, and tables staged in the cluster's shared folder."""

import contextlib
import itertools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from anemoscope.errors import ReportError

_LOCAL_FOLDERS: dict[str, str] = {}


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(
        spark._jsc.hadoopConfiguration()
    )


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(hadoop_path(spark, path))


def qualified(spark: SparkSession, path: str) -> str:
    """Absolute path with its scheme, for comparing two paths."""
    fs = file_system(spark, path)
    return fs.makeQualified(hadoop_path(spark, path)).toString().rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting: its single process is the
    whole cluster, so a temporary folder is shared by definition.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ReportError(
            "Error: set spark.checkpoint.dir to a folder all executors share."
        )
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="anemoscope-")
    return _LOCAL_FOLDERS[application]


#: Input bytes to a shuffle partition.
PARTITION_BYTES = 64_000_000


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or a folder."""
    return file_system(spark, path).getContentSummary(hadoop_path(spark, path)).getLength()


def set_partitions(spark: SparkSession, path: str) -> None:
    """Shuffle partitions by the size of the input; never fewer than the session has."""
    if exists(spark, path):
        name = "spark.sql.shuffle.partitions"
        parts = -(-size_of(spark, path) // PARTITION_BYTES)
        spark.conf.set(name, max(int(spark.conf.get(name)), parts))


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """While this lasts, Spark removes the shuffle files of a write as soon as it has ended."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Workspace:
    """A folder of its own for the staged tables of one run.

    A staged table is written once and read back, so later steps neither
    recompute it nor see a different version of it after an executor is lost.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/anemoscope/{uuid.uuid4().hex}"
        self._numbers = itertools.count()

    def stage(self, table: DataFrame, label: str) -> DataFrame:
        path = f"{self.path}/{next(self._numbers):03d}-{label}"
        table.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(table.schema).parquet(path)

    def discard(self, *labels: str) -> None:
        """Remove the tables staged so far under these labels, which nothing may read any more."""
        files = file_system(self.spark, self.path)
        for label in labels:
            found = hadoop_path(self.spark, f"{self.path}/[0-9]*-{label}")
            for status in files.globStatus(found) or []:
                files.delete(status.getPath(), True)

    def __enter__(self):
        return self

    def __exit__(self, kind, error, trace):
        """Remove the staged tables; only for a run whose results are written."""
        file_system(self.spark, self.path).delete(
            hadoop_path(self.spark, self.path), True
        )
        return False
