"""Helpers shared by the operators: table access, staged tables, Arrow texts."""

from __future__ import annotations

import ctypes
import functools
import gc
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import SHUFFLES_GO, settings

#: About how many bytes of a batch an operator handles at once.
PIECE_BYTES = 2 << 20
#: Bytes of an Arrow batch while a table is staged.
BATCH_BYTES = 12 << 20
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package (once for each application); Spark
    sends the file to the executors."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    file = Path(tempfile.mkdtemp(prefix="llm-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(file, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(file))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees (``spark.checkpoint.dir``).

    Only a local master may go without the setting; it then gets a folder of
    its own, as in tests.
    """
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-stage-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


#: Of tables with few, large rows: a row group for each MB or row, so that tasks can share them out.
LARGE_ROWS = {"parquet.block.size": str(1 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}


def staged(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to a new Parquet table in the shared folder and read it back:
    cuts the lineage, and a lost executor costs no recomputation of it.  Its
    shuffle files go once it is written.  Arrow batches are of :data:`BATCH_BYTES` at most: a
    batch is held by the executor and by its Python worker at once, and those of a
    size class of long texts would else be as large as Spark lets them."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex[:12]}"
    with settings(spark, {**SHUFFLES_GO, "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}):
        df.write.options(compression="zstd", **options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing will read again.  Only for what has been
    read into another staged table, so that a lost executor needs none of it."""
    for df in tables:
        if path := df.__dict__.get("_staged_at"):
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def hash_sample(df: DataFrame, col: str, total: int, most: int) -> DataFrame:
    """About ``most`` of the ``total`` values of a column, those of the least
    hashes: the same ones for the same values, whatever the partitions, and no
    more than that leaves the executors."""
    share = 2**40 if total <= most else int(2**40 * most / total)
    return df.where(F.pmod(F.xxhash64(col), F.lit(2**40)) < F.lit(share))


def ddl(df: DataFrame, keep: tuple[str, ...], added: str) -> T.StructType:
    """Schema of the kept columns followed by ``added`` (a DDL string)."""
    return T.StructType([df.schema[c] for c in keep] + list(T.StructType.fromDDL(added)))


def map_batches(
    df: DataFrame, columns: tuple[str, ...], keep: tuple[str, ...], added: str,
    fn: Callable[[pa.RecordBatch], dict[str, pa.Array]], tokenizes: bool = False,
) -> DataFrame:
    """Add columns to each Arrow batch.  ``fn`` gets the batch of ``columns``
    (in order, renamed ``_0``, ``_1`` …) and returns the added arrays; ``keep``
    columns pass through unchanged.  ``tokenizes``: the worker may keep pieces."""
    ship(df.sparkSession)
    schema = ddl(df, keep, added)
    names = [f.name for f in T.StructType.fromDDL(added)]
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, PIECE_BYTES * batch.num_rows // max(1, batch.nbytes))
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                own = pa.RecordBatch.from_arrays(
                    part.columns[n_keep:], names=[f"_{i}" for i in range(part.num_columns - n_keep)])
                made = fn(own)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n_keep], *[made[n] for n in names]], names=[f"k{i}" for i in range(n_keep)] + names)

    src = df.select(*[df[c].alias(f"k{i}") for i, c in enumerate(keep)],
                    *[df[c].alias(f"c{i}") for i, c in enumerate(columns)])
    inner = T.StructType([T.StructField(f"k{i}", df.schema[c].dataType) for i, c in enumerate(keep)]
                         + list(T.StructType.fromDDL(added)))
    out = src.mapInArrow(tidy(run, tokenizes), inner)
    return out.toDF(*[f.name for f in schema]) if keep else out


def release() -> None:
    """Free what tokenizing tasks keep in this worker; Spark uses workers again."""
    for module, name in (("bpe", "coder"), ("alignment", "aligner")):
        if (own := sys.modules.get(f"{__package__}.{module}")) and getattr(own, name).cache_info().currsize:
            getattr(own, name).cache_clear()
            gc.collect()


@functools.cache
def _c_library():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # another C library: its own allocator gives memory back or not
        return None


def tidy(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], tokenizes: bool = False):
    """A task that keeps no tokenizer's pieces unless it ``tokenizes``, and gives
    freed memory back to the system when it ends: a worker waits for its next
    task beside others that run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not tokenizes:
            release()
        try:
            yield from task(batches)
        finally:
            if hashing := sys.modules.get(f"{__package__}.hashing"):
                hashing.forget_powers()
            pa.default_memory_pool().release_unused()
            if (c := _c_library()) is not None:
                c.malloc_trim(0)

    return run


def texts_of(array: pa.Array) -> list[str]:
    """Python strings of a text column; null is empty."""
    return ["" if x is None else x for x in array.to_pylist()]


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column and the ``n + 1`` offsets of its rows,
    without a copy per row; null is empty."""
    if array.null_count:
        array = array.fill_null("")
    large = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offs, data = array.buffers()
    at = np.frombuffer(offs, np.int64 if large else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most_bytes`` each (at least one row)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most_bytes, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def binary_array(data: bytes, offsets: np.ndarray) -> pa.Array:
    """A binary column of adjacent pieces of ``data`` (under 2 GB a batch)."""
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data)])
