"""Helpers that several operators share."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of partial sums that the driver takes.
SENT = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Executors that are processes of their own share the session's warehouse too, so it
    is taken where that is unset. Neither is refused for its scheme: what is mounted on
    every machine looks like a folder of one, and Spark fails a checkpoint that the
    driver can't read back. Where Spark runs in one process, a folder in /tmp will do.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", context.master):
            folder = spark.conf.get("spark.sql.warehouse.dir", None)
            if not folder:
                raise ValueError("set spark.checkpoint.dir to a shared folder")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that a job has made and no later one reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(place, True)


#: Where ``stored`` has put rows since somebody began to ask.
_made: ContextVar[list[str] | None] = ContextVar("_made", default=None)


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written to the shared folder: later jobs read them there."""
    shared_folder(df.sparkSession)
    found = df.checkpoint()
    if (made := _made.get()) is not None:
        place = found._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if place.isDefined():
            made.append(place.get())
    return found


@contextmanager
def stored_for_now(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what ``stored`` has written in between."""
    token = _made.set([])
    try:
        yield
    finally:
        for path in _made.get():
            remove_folder(spark, path)
        _made.reset(token)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a row is kept from learning; a row without an id is not."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % folds == fold
    return F.coalesce(rest, F.lit(False))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as make it none of the columns'."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, name: str, kept_out: Column, rows: int
) -> DataFrame:
    """(text, label) of at most ``rows`` labelled rows that ``kept_out`` doesn't hold.

    Ids are taken in order of a hash, so a sample is the same at every run; an id
    with two labels has the larger. Equal texts of one label are one row, made so in
    each task before they meet, and of an id's many texts only so many are taken that
    the sample stays bounded; then the order is that of a hash of the text. As the
    ids are bounded, they are broadcast. The sample is stored, in many tasks.
    """
    known = labels.where(F.col(name).isNotNull() & F.col("doc_id").isNotNull() & ~kept_out)
    known = known.groupBy(F.col("doc_id").cast("long").alias("_labelled"))
    known = known.agg(F.max(F.col(name).cast("int")).alias("_label"))
    known = known.orderBy(F.xxhash64("_labelled"), "_labelled").limit(rows)
    same = F.col("doc_id").cast("long") == F.col("_labelled")
    found = docs.select("doc_id", "text").join(F.broadcast(known), same)
    found = found.select("text", F.col("_label").alias("label")).distinct()
    found = stored(found.withColumn("_mark", F.xxhash64("text", "label")))
    marks = found.select("_mark").orderBy("_mark").limit(rows)
    last = marks.agg(F.max("_mark")).first()[0]
    return found.where(F.col("_mark") <= F.lit(last).cast("long")).drop("_mark")


def summed(arrays: DataFrame, size: int) -> np.ndarray:
    """The sum of ``arrays`` (sum binary, ``size`` doubles each), one row a task.

    Many are added in ever fewer tasks, each of which holds two at a time, so the
    driver is sent ``SENT`` bytes at most, or one array. No rows give zeros.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for own in batch.column(0):
                total += np.frombuffer(own.as_buffer())
        yield pa.RecordBatch.from_pydict({"sum": [total.tobytes()]})

    most = max(1, min(64, SENT // (8 * size + 1)))
    count = arrays.rdd.getNumPartitions()
    while count > most:
        count = max(count // 64, 1) if count > 64 * most else most
        arrays = arrays.repartition(count).mapInArrow(add, "sum binary")
    total = np.zeros(size)
    for row in arrays.collect():
        total += np.frombuffer(bytes(row["sum"]))
    return total
