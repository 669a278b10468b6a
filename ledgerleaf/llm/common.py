"""Helpers that the training-data operators share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words everywhere in this subpackage: ASCII white space and nothing else.
WORD = r"[^\x20\x09-\x0D]+"

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which driver and executors share.

    Only where the session names none (a local test) is one made on this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not _own_folder:
        _own_folder.append("file://" + tempfile.mkdtemp(prefix="ledgerleaf-"))
    return _own_folder[0]


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write df as a table in the shared folder and read it back: a cut in the lineage that outlives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that `written` made, once nothing will read it again."""
    spark = df.sparkSession
    for file in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Ask the driver's JVM to collect garbage, so that shuffle files no plan refers to any more leave the disks."""
    spark.sparkContext._jvm.System.gc()


def tidy() -> None:
    """In a Python worker, at a partition's end: give memory back that the worker would hold idle beside the JVM."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def collector_paused() -> Iterator[None]:
    """In a Python worker: no search for cycles meanwhile, for code that makes many small objects and no cycles."""
    import gc

    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once for a row, also where body uses it in lambdas.

    The optimizer may copy a column's expression into every place that uses it; a lambda's variable it can't copy.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def select_required(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only the named columns, so that extra columns can't clash with an operator's own."""
    return df.select(*[F.col(f"`{x}`") for x in names])


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Names that no column of df has, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    return [next(name for k in range(len(taken) + 1) if (name := f"{s}_{k}").lower() not in taken) for s in stems]
