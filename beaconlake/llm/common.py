"""What several operators of this subpackage share: cell access, word rules, files in the shared folder."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_SCHEME = re.compile(r"^file:(//)?(?=/)")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone; other columns, whatever their names, are pruned at the scan."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, megabytes: int = 4) -> None:
    """Smaller Arrow batches in a session that has Spark's default of 64 MB: a row here is a text or a set, and a batch stands
    in the JVM and in Python, there twice over while it is read. A session's own bound stays."""
    if spark.conf.get(ARROW_BYTES).rstrip("b") == str(64 << 20):
        spark.conf.set(ARROW_BYTES, f"{megabytes}m")


#: What this worker holds for its next tasks of the same kind: how to let go of it, by name.
_held: dict[str, Callable[[], object]] = {}


def hold(name: str, release: Callable[[], object]) -> None:
    _held[name] = release


def let_go(holds: str | None) -> None:
    """Drop what the worker holds, but for ``holds``."""
    for name, release in _held.items():
        if name != holds:
            release()


def give_back() -> None:
    """Free memory goes back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps what small arrays leave
    if trim is not None:
        trim(0)


def tidy(run, holds: str | None = None):
    """A batch function after which its worker, which Spark keeps for later tasks of any kind, gives free memory back to the
    machine, and before which it drops what tasks of other kinds hold. ``holds`` is what this one uses."""

    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(holds)
        give_back()
        try:
            yield from run(batches)
        finally:
            gc.collect()
            give_back()

    return tidied


def fold(n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def fold_of(doc_id: int | None, n: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def raw_texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """UTF-8 bytes of each row's text, empty for null, one row at a time without decoding."""
    column = batch.column(name)
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    for cell in column:
        yield b"" if not cell.is_valid else cell.as_py()


def words(raw: bytes) -> list[bytes]:
    """``[^\\x20\\x09-\\x0D]+``: the bytes that bytes.split() splits at are exactly those."""
    return raw.split()


def local_path(uri: str) -> str:
    """The path of a folder that every machine mounts; the memory-mapped formats need one."""
    path = LOCAL_SCHEME.sub("", uri)
    if "://" in path:
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {uri}")
    return path


def commit_file(path: str, payload_writer) -> None:
    """Write under a name of this attempt, then rename: a retried or speculative task never shows half a file."""
    temporary = f"{path}.{os.getpid()}.{os.urandom(4).hex()}"
    with open(temporary, "wb") as out:
        payload_writer(out)
    os.replace(temporary, path)
