"""Column expressions and small helpers that several operators share."""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemoscope.sources import storage

#: ``bytes.split()`` and ``bytes.lower()`` know exactly the blanks ``[\x20\x09-\x0D]``
#: and the letters A-Z, which is how words are defined throughout this package.
BLANKS = " \t\n\v\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8, as written; none for null."""
    return text.encode().split() if text else []


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % folds).cast("int")


def fold_value(doc_id: int | None, folds: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def text_bytes(table: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column; what the number of chunks is taken from."""
    return table.agg(F.sum(F.octet_length(column))).first()[0] or 0


def chunks_for(size: int, per_chunk: int) -> int:
    return max(1, -(-size // per_chunk))


def rows_of(batches: Iterator[pa.RecordBatch], *names: str, at_most: int = 2_000):
    """Lists of the named columns, a bounded number of rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, at_most):
            part = batch.slice(start, at_most)
            yield [part.column(part.schema.get_field_index(n)).to_pylist() for n in names]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, field.type)
        for c, field in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    values = values.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        values ^= values >> np.uint64(shift)
        values *= np.uint64(factor)
    values ^= values >> np.uint64(33)
    return values


#: While a table is staged: Spark removes the write's shuffle files as soon as it has ended,
#: and sends Python batches of at most so many bytes (or one row), so that two tasks with
#: long texts don't hold large buffers beside the heap. Rows are read few at a time, as a
#: reader's buffers grow to all texts or sets of its rows.
WHILE_STAGING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
}


class Staging(storage.Workspace):
    """Tables of one operator run in the cluster's shared folder.

    What a staged table was shuffled for is removed when it is written: it is read from the
    table from then on. A result that is still lazy reads its tables, so they outlive the
    call; whoever materialises the result may call ``release``.
    """

    def stage(self, table: DataFrame, label: str) -> DataFrame:
        conf = self.spark.conf
        before = {name: conf.get(name, None) for name in WHILE_STAGING}
        for name, value in WHILE_STAGING.items():
            conf.set(name, value)
        try:
            return super().stage(table, label)
        finally:
            for name, value in before.items():
                conf.unset(name) if value is None else conf.set(name, value)

    def release(self) -> None:
        self.__exit__(None, None, None)


def fresh(name: str, *taken: DataFrame) -> str:
    """``name``, with underscores before it until no column of the tables is called so."""
    used = {c.lower() for table in taken for c in table.columns}
    while name.lower() in used:
        name = "_" + name
    return name
