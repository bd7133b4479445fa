"""Shared helpers of the corpus operators: shared-folder tables, code shipping and text columns.

Conventions of every operator in this subpackage:

* a null text counts as the empty text; a null id is an ordinary value and yields a row like any other;
* an empty table gives an empty result with the full schema;
* only the named id and text columns are read; operators that pass rows through rename all columns first (``renamed``) and back
  at the end, so extra columns, whatever their names, never clash;
* repeated rows are processed as often as they occur unless the docstring says otherwise.
"""

from __future__ import annotations

import ctypes
import re
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the size and shingle contracts: anything between blanks, tabs, line breaks.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; the path may belong to any file system that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def renamed(docs: DataFrame, *used: str):
    """``docs`` under plain names (c0, c1, ...), so that no name of an operator's own can meet one of them; how to get the columns back; and
    the plain names of the columns ``used``."""
    names = docs.columns
    plain = [f"c{i}" for i in range(len(names))]
    at = {name.lower(): p for name, p in reversed(list(zip(names, plain, strict=True)))}
    return docs.toDF(*plain), lambda df: df.select(*plain).toDF(*names), [at[name.lower()] for name in used]


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else; null becomes the empty text."""
    return F.translate(F.coalesce(col, F.lit("")), UPPER, UPPER.lower())


def shared_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; on a local master (tests) a temporary one is set once where it is unset."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    own = spark.conf.get("phraseloom.shared.dir", None)
    if own is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        own = Path(tempfile.mkdtemp(prefix="phraseloom-")).as_uri()
        spark.conf.set("phraseloom.shared.dir", own)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/phraseloom/{label}-{uuid.uuid4().hex}"


#: Paths written within each open ``cleared`` block, innermost last.
_written: list[list[str]] = []


@contextmanager
def cleared(spark: SparkSession):
    """Tables that are materialized in the block are deleted at its end: nothing that outlives it may read them."""
    _written.append([])
    try:
        yield
    finally:
        for path in _written.pop():
            delete(spark, path)


def materialize(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read it back. Survives lost executors."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    if _written:
        _written[-1].append(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch = path
    return back


def remove(spark: SparkSession, df: DataFrame) -> None:
    """Delete a materialized table that no later plan reads."""
    delete(spark, df.scratch)


def delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per context, so that workers import it whatever their PYTHONPATH."""
    sc = spark.sparkContext
    if getattr(sc, "_phraseloom_shipped", False):
        return
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))  # long texts: bounded batches
    top = Path(__file__).resolve().parents[2]
    target = Path(tempfile.mkdtemp(prefix="phraseloom-zip-")) / "phraseloom_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((top / "phraseloom").rglob("*.py")):
            z.write(p, p.relative_to(top))
    sc.addPyFile(str(target))
    sc._phraseloom_shipped = True


#: What workers keep between tasks: models with caches of a hundred megabytes or more.
KEPT = ("byte_bpe.prefix_counter", "byte_bpe.piece_encoder", "pieces.lattice", "quality._compressor", "toxicity._scorer")


def keep_only(name: str | None) -> None:
    """In a reused worker, free what other operators keep: an executor never holds the models of two stages."""
    for other in KEPT:
        module, attribute = other.split(".")
        loaded = sys.modules.get(f"phraseloom.llm.{module}")
        if other != name and loaded is not None:
            getattr(loaded, attribute).cache_clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)  # freed memory goes back to the system, not to the worker's next stage
    except (AttributeError, OSError):
        pass


def map_arrow(df: DataFrame, func, schema, keeps: str | None = None) -> DataFrame:
    """mapInArrow with the package shipped; ``func`` takes and yields RecordBatches, ``keeps`` names its model of KEPT."""
    ship(df.sparkSession)

    def run(batches):
        from phraseloom.llm import common

        common.keep_only(keeps)
        yield from func(batches)

    return df.mapInArrow(run, schema)


def small_batches(batches: Iterable[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slice batches so that ``column`` (texts or bytes) holds about ``limit`` bytes in each slice; a longer row stands alone."""
    for batch in batches:
        size = batch.column(column).nbytes
        if size <= limit or batch.num_rows < 2:
            yield batch
            continue
        step = max(1, batch.num_rows * limit // size)
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def rows_below(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` (a written table) has at most ``limit`` rows: the size check before a broadcast."""
    return df.limit(limit + 1).count() <= limit


def join_small(left: DataFrame, right: DataFrame, on, how: str, broadcast_rows: int) -> DataFrame:
    """Broadcast ``right`` where its counted rows stay below ``broadcast_rows``; else a shuffled join that AQE may split."""
    return left.join(F.broadcast(right) if rows_below(right, broadcast_rows) else right.hint("merge"), on, how)
