"""Token ids as flat unsigned integer files with 64-bit document offsets, written by tasks and read back by memory maps.

Format: a folder with, for each part ``p`` in ascending order of doc_id, ``p.ids`` (little-endian unsigned integers, the
narrowest of 16 and 32 bits that holds the vocabulary), ``p.offsets`` (n + 1 little-endian 64-bit starts within the
part) and ``p.docs`` (n little-endian 64-bit doc_ids). ``parts``, a Parquet table beside them, has one row a part: number,
documents, ids, and ``base``, the ids of all parts before it. Every document ends with ``end_id``.

Defined cases: a null text counts as empty and gives the end id alone. A null doc_id is written as the smallest 64-bit
integer and read back as null; such documents come first. Repeated doc_ids are kept, in an order left open. An empty table
gives a folder without parts and a reader without rows. Special-token strings inside a text become their ids, as the
library does by default.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beaconlake.llm.common import commit_file, local_path, raw_texts, texts
from beaconlake.llm.tokens import encoder
from beaconlake.session import run_dir

NULL_ID = -(2**63)
#: Documents buffered before their ids are appended to the part's file.
CHUNK_BYTES = 8 << 20


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, partitions: int | None = None) -> None:
    """Write ``docs`` (doc_id, text) to ``folder``, which all machines mount, in ascending doc_id order."""
    place = local_path(folder)
    dtype = "<u2" if _vocabulary(tokenizer_path, end_id) <= 2**16 else "<u4"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer_path).encode
        ids_of, lengths = [], []
        os.makedirs(place, exist_ok=True)

        def stream(out) -> None:
            held: list[bytes] = []
            size = 0
            for batch in batches:
                ids_of.extend(NULL_ID if i is None else i for i in batch.column("doc_id").to_pylist())
                for found in encode(raw_texts(batch)):
                    ids = np.append(found, np.uint32(end_id)).astype(dtype).tobytes()
                    lengths.append(len(ids) // int(dtype[-1]))
                    held.append(ids)
                    size += len(ids)
                    if size > CHUNK_BYTES:
                        out.write(b"".join(held))
                        held.clear()
                        size = 0
            out.write(b"".join(held))

        name = f"{place}/{part:06d}"
        commit_file(f"{name}.ids", stream)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
        commit_file(f"{name}.offsets", lambda out: out.write(offsets.tobytes()))
        commit_file(f"{name}.docs", lambda out: out.write(np.array(ids_of, "<i8").tobytes()))
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "docs": [len(lengths)], "ids": [int(offsets[-1])], "dtype": [dtype]},
            schema=pa.schema([("part", pa.int32()), ("docs", pa.int64()), ("ids", pa.int64()), ("dtype", pa.string())]),
        )

    spread = texts(docs)
    ordered = spread.repartitionByRange(*([partitions] if partitions else []), "doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"))  # a retried task writes the same file
    written = ordered.mapInArrow(write, "part int, docs long, ids long, dtype string")
    written.write.parquet(f"{folder}/counts")
    # one row a file: a running sum over the manifest, not over documents
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = docs.sparkSession.read.schema("part int, docs long, ids long, dtype string").parquet(f"{folder}/counts")
    manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0))).write.parquet(f"{folder}/parts")


def _vocabulary(path: str, end_id: int) -> int:
    return max(encoder(path).tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)


def mapped(place: str, part: int, dtype: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Memory maps of one part: ids, offsets, doc_ids."""
    name = f"{place}/{part:06d}"

    def open_map(path: str, kind: str) -> np.ndarray:
        return np.memmap(path, dtype=kind, mode="r") if os.path.getsize(path) else np.zeros(0, kind)

    return open_map(f"{name}.ids", dtype), open_map(f"{name}.offsets", "<i8"), open_map(f"{name}.docs", "<i8")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document; ``start`` counts the ids of all documents before it."""
    place = local_path(folder)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, doc_ids = mapped(place, row["part"], row["dtype"])
                for at in range(0, len(doc_ids), 4096):
                    chosen = doc_ids[at : at + 4096]
                    bounds = offsets[at : at + len(chosen) + 1]
                    sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
                    columns = [
                        pa.array(chosen, mask=chosen == NULL_ID),
                        pa.array(row["base"] + bounds[:-1]), pa.array(np.diff(bounds)), pa.array(sums, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    manifest = spark.read.schema("part int, docs long, ids long, dtype string, base long").parquet(f"{folder}/parts")
    parts = manifest.where("docs > 0")
    spread = parts.repartition(max(1, parts.count()), "part")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write ``docs`` to a fresh folder of the shared storage and read the files back."""
    folder = run_dir(docs.sparkSession, "token-files")
    write_token_files(docs, tokenizer_path, end_id, folder)
    return read_token_files(docs.sparkSession, folder)
