"""What the operators share: scratch tables, text slices for Arrow batches, word arrays."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Words of every contract here: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows up to which a table may be broadcast; every caller counts before it does.
BROADCAST_ROWS = 100_000


#: Spark's setting by which a query's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession) -> str:
    """The folder that the driver and all executors share. Where none is set, one of our own on a single machine; a
    cluster must set one, for its executors would not see each other's files."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "/tmp/checkpoints"
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends there, a lost executor costs no rework, and the shuffle
    files that led to it are removed."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/tables/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A materialised table, marked for broadcast only if it has few rows; else Spark shuffles it."""
    return F.broadcast(df) if df.count() <= rows else df


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def texts_of(batch: pa.RecordBatch, text: str) -> pa.Array:
    """The text column inside a batch's `row` struct, so that texts are sent once; null counts as empty."""
    return batch.column("row").field(text).fill_null("")


def beside_row(packed: DataFrame, more: str) -> StructType:
    """The schema of packed's column `row`, whatever the names inside it, with further columns (DDL)."""
    return StructType([packed.schema["row"], *StructType.fromDDL(more)])


def slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges whose lengths sum to at most `most`; a longer row stands alone."""
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)
