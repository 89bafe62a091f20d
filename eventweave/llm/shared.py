"""What the text operators share: the folder that all executors see, work tables, compressed text rows."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


#: Bytes of a batch of rows that goes to a Python worker (texts may be long, and several batches are in memory at a time).
BATCH_BYTES = "16m"


def small_batches(spark: SparkSession, size: str = BATCH_BYTES) -> None:
    """Sets the size of the batches that Python workers get, which bounds their memory and that of the executor beside them."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only where that is unset on a single machine a temporary one is made."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-work-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """df written once to the shared folder and read back: later steps restart from the files when an executor is lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes work tables made by stored() that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 1 when divided by 3; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def packed(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and the text as compressed bytes (column ``z``), for shuffles that must carry texts."""
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep) + ", z binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = [None if t is None else zlib.compress(t, 1) for t in b.column(text).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array(z, pa.binary())], names=[*keep, "z"])

    return df.select(*keep, text).mapInArrow(pack, schema)


def unpacked(column: pa.Array) -> pa.Array:
    return pa.array([None if z is None else zlib.decompress(z) for z in column.to_pylist()], pa.large_binary())


def rows(names: list[str], *columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


#: Rows of a label table up to which it is sent to the tasks (16 bytes a row); beyond, texts are shuffled in compressed form.
BROADCAST_LABELS = 2_000_000


def with_label(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """doc_id, the label and the text (column ``text``, or compressed as ``z``) of each labelled row of docs."""
    labels = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias(label))
    rows_there = labels.limit(BROADCAST_LABELS + 1).count()
    if rows_there <= BROADCAST_LABELS:
        return docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id")
    return packed(docs.select("doc_id", "text"), ["doc_id"]).join(labels, "doc_id")


def text_column(batch: pa.RecordBatch) -> pa.Array:
    return unpacked(batch.column("z")) if "z" in batch.schema.names else batch.column("text")


def without_ids(df: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows of df whose ``column`` is null or not in the distinct ids."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, column, "left_anti")


#: Ids up to which a set of wanted rows is sent to the tasks (8 bytes an id); beyond, both sides are shuffled.
BROADCAST_IDS = 2_000_000


def with_ids(df: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows of df whose ``column`` is in the distinct ids (a column of the same name)."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, column, "left_semi")
