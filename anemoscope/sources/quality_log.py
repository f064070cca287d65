"""The append-only audit log: committed batches of entries, partitioned by run date.

A batch is what one cleaning run logs. Its entries are written into a folder of their own,
then a commit record that names them; entries without one are not read. Appending a batch
again replaces what an interrupted attempt has left, and does nothing once it is committed.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anemoscope import config
from anemoscope.sources import storage

RUN_DATE, BATCH = "run_date", "batch"
SCHEMA = T.StructType(
    [
        T.StructField(name, T.LongType() if name == "row_count" else T.StringType())
        for name in config.LOG_FIELDS
    ]
)
_PLACE = [T.StructField(RUN_DATE, T.DateType()), T.StructField(BATCH, T.StringType())]
_STORED = T.StructType([*SCHEMA.fields, *_PLACE])
_COMMIT = T.StructType([*_PLACE, T.StructField("entries", T.LongType())])


def append(log: DataFrame, path: str) -> None:
    """Add the entries of a run to the log; earlier entries are never touched."""
    spark = log.sparkSession
    log = log.select(*config.LOG_FIELDS)
    run_date = F.substring("run_timestamp", 1, 10).cast("date")
    found = log.agg(
        F.min("run_id").alias(BATCH), F.min(run_date).alias(RUN_DATE), F.count(F.lit(1)).alias("entries")
    ).first()
    if not found["entries"] or _committed(spark, path, found[BATCH]):
        return
    (
        log.withColumns({RUN_DATE: run_date, BATCH: F.lit(found[BATCH])})
        .repartition(RUN_DATE, F.pmod(F.xxhash64("run_id"), F.lit(config.SALTS)))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(RUN_DATE, BATCH)
        .parquet(_entries(path))
    )
    _commit(spark, path, found)


def _entries(path: str) -> str:
    return f"{path.rstrip('/')}/entries"


def _commits(path: str, batch: str = "*") -> str:
    return f"{path.rstrip('/')}/commits/{batch}"


def _committed(spark: SparkSession, path: str, batch: str) -> bool:
    return storage.exists(spark, f"{_commits(path, batch)}/_SUCCESS")


def _commit(spark: SparkSession, path: str, found) -> None:
    record = [(found[RUN_DATE], found[BATCH], found["entries"])]
    record = spark.createDataFrame(record, _COMMIT).coalesce(1)
    record.write.mode("overwrite").parquet(_commits(path, found[BATCH]))


def read(
    spark: SparkSession,
    path: str,
    run_id: str | None = None,
    run_date: date | None = None,
) -> DataFrame:
    """Committed log entries, of one run if asked; the date prunes partitions."""
    if not storage.exists(spark, _commits(path, "").rstrip("/")):
        return spark.createDataFrame([], SCHEMA)
    log = spark.read.schema(_STORED).parquet(_entries(path))
    commits = spark.read.schema(_COMMIT).parquet(_commits(path))
    if run_date is not None:
        log = log.filter(F.col(RUN_DATE) == F.lit(run_date))
        commits = commits.filter(F.col(RUN_DATE) == F.lit(run_date))
    if run_id is not None:
        log = log.filter(F.col("run_id") == run_id)
    return log.join(commits.select(BATCH), BATCH, "left_semi").select(*config.LOG_FIELDS)
