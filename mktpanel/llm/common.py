"""Word and column helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mktpanel import session
from mktpanel.llm.tokens import forget_encoders
from mktpanel.session import shared_dir

__all__ = ["BLANKS", "SPACE_RUN", "batches_by_key", "byte_texts", "discard", "materialize", "releasing", "shared_dir",
           "shuffle_files_removed", "slices", "table", "word_count", "words"]

# A word is a run of characters other than space, tab, line feed, vertical tab,
# form feed and carriage return.  ``bytes.split()`` splits on the same six.
BLANKS = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


# Shuffle files of a finished write go at once, not when the driver's garbage collector meets them.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write in this block are removed as it ends."""
    conf = spark.conf
    before = conf.get(_SHUFFLE_CLEANUP, None)
    conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            conf.unset(_SHUFFLE_CLEANUP)
        else:
            conf.set(_SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str = "stage", partition_by: str | None = None) -> DataFrame:
    """A written table as of ``session.materialize``; the shuffle files of the write are removed as it ends."""
    with shuffle_files_removed(df.sparkSession):
        return session.materialize(df, name, partition_by)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def discard(*tables: DataFrame) -> None:
    """Remove written tables (of ``materialize``) once the tables made of them are written.

    Nothing that is read later may derive from them; a table's files are all
    in one folder of its own.
    """
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/mktpanel/" not in folder or not folder.endswith("/table"):
                raise ValueError(f"not a written table of this library: {folder}")
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def words(text: Column) -> Column:
    """Array of the words of ``text``; an empty array for null and blank texts."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_RUN)).otherwise(F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null and blank texts."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(trimmed) > 0, F.size(F.split(trimmed, SPACE_RUN))).otherwise(0).cast("long")


def byte_texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them first."""
    return column.cast(pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that few texts at once are Python's."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _release_memory() -> None:
    """Memory that is free in this process goes back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass  # not every C library has it


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], encoders: bool = False):
    """``run`` of a mapInArrow that gives free memory back as its task ends.

    Spark's workers wait for their next task beside the executor, also while
    steps without Python run there.  ``encoders``: the worker's encoders are
    kept, as ``run`` uses them; other steps drop them.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not encoders:
            forget_encoders()
        try:
            yield from run(batches)
        finally:
            _release_memory()

    return task


def batches_by_key(batches: Iterator[pa.RecordBatch], key: str, rows: int = 400_000) -> Iterator[pa.Table]:
    """Regroup a stream sorted by ``key`` into tables that never cut a key in two.

    A table holds about ``rows`` rows, or one key's rows where these are more.
    """
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if n >= rows:
            keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            last = held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py()
            other = (keys != last).nonzero()[0]
            if len(other):
                cut = int(other[0])
                yield pa.Table.from_batches(held + ([batch.slice(0, cut)] if cut else []))
                held, n = [], 0
                batch = batch.slice(cut)
        held.append(batch)
        n += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)
