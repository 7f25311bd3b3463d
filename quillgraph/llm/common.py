"""What the corpus operators share: tables, shared checkpoints, hash folds, Arrow limits."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Word separators of every contract: space and 0x09 to 0x0D. bytes.split() cuts at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table of that name under sf_dir, by Spark's reader only (any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_limits(spark: SparkSession) -> None:
    """Bounds what a Python worker holds at once: rows and bytes of an Arrow batch.

    Every operator here sets the same two values for the session and leaves them, as its plan may run at any later time.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only on a local master may it be unset: then a temporary folder."""
    sc = spark.sparkContext
    set_ = sc._jsc.sc().getCheckpointDir()
    if set_.isEmpty():
        path = sc.getConf().get("spark.checkpoint.dir")
        if not path:
            if sc.master.split("[")[0] != "local":
                raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
            path = tempfile.mkdtemp(prefix="quillgraph-")
        sc.setCheckpointDir(path)
        set_ = sc._jsc.sc().getCheckpointDir()
    return set_.get()


def cut(df: DataFrame) -> DataFrame:
    """df written once to the shared folder, without its lineage; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As cut(), as compressed Parquet: for wide or large intermediate tables that later steps read in part."""
    path = f"{shared_dir(df.sparkSession)}/quillgraph-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes what stored() wrote, once nothing that is still to run reads it."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """`row`, all columns of docs in one struct, beside the given ones: whatever names docs has, none clashes with these."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *[c.alias(k) for k, c in columns.items()])


def unpacked(rows: DataFrame) -> DataFrame:
    """The rows that packed() put away."""
    return rows.select("row.*")


def beside(docs: DataFrame, start: Callable[[], Callable[[list], list[pa.Array]]], fields: list[T.StructField], text: str = "text") -> DataFrame:
    """`row` (all columns of docs) and the fields that a function makes of the texts, one pass without a shuffle.

    start() gives that function once a task; it takes the texts of a batch and returns an array for each field.
    """
    arrow_limits(docs.sparkSession)
    rows = packed(docs)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), *make(b.column(0).field(at).to_pylist())], ["row", *(f.name for f in fields)])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], *fields]))


def id_remainder(mod: int, col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo mod; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def texts(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns asked for and no other, so that extra columns with clashing names do no harm."""
    return docs.select(*[docs[c] for c in columns])


def sampled(docs: DataFrame, rows: int, by: str = "doc_id") -> DataFrame:
    """About `rows` of the rows (all, if there are no more), those whose id hash is below rows / count; written once.

    The bounded samples that classifiers are fitted on: the same whatever the order or partitioning, no sort, no shuffle.
    """
    n = docs.count()
    share = 1.0 if n <= rows else rows / n
    return stored(docs.where(F.pmod(F.xxhash64(F.coalesce(F.col(by).cast("string"), F.lit("")), F.lit(2026)), F.lit(1 << 20)) < int(share * (1 << 20))))
