"""What the training-data operators share: table reads, Arrow maps, written intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


#: Rows of an Arrow batch that are Python objects at one time.
ROWS = 1000
#: Bytes of an Arrow batch between the JVM and Python where ``small_batches`` was called.
BATCH = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where that is unset a temporary folder takes its place if driver and executors are
    one process (``local`` masters, as in tests); on a cluster that is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="recordloom-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back, which cuts its lineage.

    The files survive lost executors. They lie under the application's id.
    ``discard`` removes one result's; operators do so for what no result of theirs
    reads. ``clean_up`` removes all that an application has left, once its results
    are written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/recordloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._recordloom_path = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes the files of a ``materialize`` result that nothing reads any more."""
    path = getattr(df, "_recordloom_path", None)
    if path:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


def few(df: DataFrame, rows: int = 1 << 20) -> DataFrame:
    """A written table of narrow rows, to be broadcast if it has at most ``rows``; beyond, joined by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def release(spark: SparkSession) -> None:
    """Has the driver find the shuffles of finished jobs that nothing needs any more, so that executors delete their files now, not at the driver's next collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches to ``BATCH`` bytes, unless they are smaller already.

    Spark's own bounds, 10,000 rows and 64 MB, let a batch of whole texts grow to that
    in each task, in the JVM and in its Python worker, there and back. Results don't
    depend on it. Plans are made when a result is written, so it stays set.
    """
    now = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < now <= BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def clean_up(spark: SparkSession) -> None:
    """Deletes all files of ``materialize`` of this application. Results that aren't written yet can't be read after that."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/recordloom/{spark.sparkContext.applicationId}")
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def own_names(df: DataFrame, *names: str) -> list[str]:
    """For each name a column name that ``df`` hasn't, however it writes its own."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def map_arrow(df: DataFrame, fn: Callable[..., list], schema: StructType, rows: int = ROWS) -> DataFrame:
    """``fn(*columns as lists) -> list of columns`` over each Arrow batch of ``df``, at most ``rows`` rows at a time."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows)):
            if batch.num_rows:
                got = fn(*(c.to_pylist() for c in batch.columns))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(got, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


def filter_rows(df: DataFrame, column: str, keep: Callable[[list], list[bool]]) -> DataFrame:
    """The rows of ``df``, all columns as they are, for whose ``column`` values ``keep`` says so."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            if batch.num_rows:
                yield batch.filter(pa.array(keep(batch.column(at).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


class Memo(dict):
    """``memo[key]`` is ``make(key)``, kept for at most ``most`` keys; then it starts anew. Texts over ``long`` aren't kept.

    A process keeps one ``alone`` memo: when another is filled, the one before is
    emptied. Workers that go from stage to stage would keep those of all stages else.
    """

    holder: Memo | None = None

    def __init__(self, make: Callable, most: int = 400_000, long: int = 64, *, alone: bool = False):
        super().__init__()
        self.make, self.most, self.long, self.alone = make, most, long, alone

    def __missing__(self, key):
        if self.alone and Memo.holder is not self:
            if Memo.holder is not None:
                Memo.holder.clear()
            Memo.holder = self
        if len(self) >= self.most:
            self.clear()
        value = self.make(key)
        if isinstance(key, int) or len(key) <= self.long:
            self[key] = value
        return value
