"""What the operators share: the shared folder, tables written to cut lineage, joins that split hot keys."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of input that a task turns into one batch of output.
SLICE_BYTES = 8 << 20
#: Rows that Spark passes to Python at once where the session does not say: whole texts are large rows.
BATCH_ROWS = 512
#: Words of 64 bits in the map of ``may_match``.
WORDS = 1 << 18
#: A key is hot if it holds more than one row in so many: there are at most as many hot keys, whatever the table.
HOT_SHARE = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where that is unset, a temporary folder serves a local session (as in tests); a cluster
    without the setting is refused, since a machine-local folder would lose data there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    found = tempfile.mkdtemp(prefix="tessera-")
    spark.sparkContext.setCheckpointDir(f"file://{found}")
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Pass ``BATCH_ROWS`` rows at a time to Python, if the session has Spark's own default there.

    Spark looks at the setting when a query runs, so an operator that returns a DataFrame cannot put
    it back; a session that sets it (as ``tessera.session`` does) is left as it is.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def in_slices(batches: Iterator[pa.RecordBatch], max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``max_bytes``, so that what a task makes of one is bounded by bytes, not rows."""
    for batch in batches:
        rows = max(1, int(max_bytes * batch.num_rows / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        pa.default_memory_pool().release_unused()


def text_of(documents: DataFrame, text_col: str) -> tuple[DataFrame, Callable[[pa.RecordBatch], pa.Array]]:
    """The rows as ``doc`` (and their text beside it only where it is no string), and what reads the texts from a batch."""
    small_batches(documents.sparkSession)
    if documents.schema[text_col].dataType.typeName() == "string":
        at = documents.columns.index(text_col)
        return documents.select(F.struct("*").alias("doc")), lambda batch: batch.column("doc").field(at)
    return documents.select(F.struct("*").alias("doc"), F.col(text_col).cast("string").alias("text")), lambda batch: batch.column("text")


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast ``value``; the result gives it inside tasks, the same object to all tasks of a worker.

    It is pickled with its class, as executors need not have this package.
    """
    held = spark.sparkContext.broadcast({"pickled": cloudpickle.dumps(value)})

    def get() -> Any:
        found = held.value
        if "live" not in found:
            found["live"] = pickle.loads(found["pickled"])
        return found["live"]

    return get


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: later steps survive lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folder behind a materialized table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def join_hot(rows: DataFrame, unique: DataFrame, on: str, weight: Column, total: int, how: str = "inner") -> DataFrame:
    """Join ``rows`` with a table that has each key ``on`` once, without a task for all rows of a hot key.

    ``weight`` is how many rows meet a key, ``total`` all of them: at most ``HOT_SHARE`` keys can
    hold more than one row in ``HOT_SHARE``, so these are broadcast; no other key is hot. ``unique``
    is read three times, so it should be materialized. ``how`` is inner, left or left_semi.
    """
    hot = unique.filter(weight * HOT_SHARE > total)
    marked = rows.join(F.broadcast(hot.select(on, F.lit(True).alias("_hot"))), on, "left")
    spread = marked.filter("_hot IS NULL").drop("_hot").join(unique.filter(~(weight * HOT_SHARE > total)), on, how)
    return spread.unionByName(marked.filter("_hot").drop("_hot").join(F.broadcast(hot), on, how))


def may_match(rows: DataFrame, keys: DataFrame, on: str, words: int = WORDS) -> DataFrame:
    """Add ``maybe``: false only if ``keys`` has no row with this value in the column ``on``.

    A map of ``words`` words of 64 bits is broadcast, whatever the tables; with many more keys than
    bits it says true to all rows. So rows that can have no match stay out of the shuffle of a join.
    """
    place = F.pmod(F.xxhash64(on), F.lit(64 * words))
    word, bit = F.floor(place / 64).cast("int"), (place % 64).cast("int")
    bits = keys.select(word.alias("_word"), bit.alias("_bit")).distinct().selectExpr("_word", "shiftleft(1L, _bit) AS b").groupBy("_word").agg(F.bit_or("b").alias("_bits"))
    found = rows.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(bits), "_word", "left")
    return found.withColumn("maybe", F.coalesce(F.getbit("_bits", F.col("_bit")) == 1, F.lit(False))).drop("_word", "_bit", "_bits")
