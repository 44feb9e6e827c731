"""Operator 5: token ids as flat binary files with 64-bit document offsets.

``write_token_files`` sorts the documents by id across partitions, encodes
each partition (a shard) and writes, per shard,

* ``shard-N.ids``      the ids of all its documents, unsigned little-endian, nothing else: 16 bits wide where
  every id of the vocabulary fits, else 32,
* ``shard-N.docs``     the documents' ids, signed 64-bit little-endian,
* ``shard-N.offsets``  for each document its first id's place in the whole sequence of ids, and one
  closing entry: unsigned 64-bit little-endian,

and a Parquet ``manifest`` with a row per shard (shard, base, n_docs, n_tokens). A shard's base is the prefix
sum of the token counts of the shards before it, so the shards read one after the other are one flat file.
``read_token_files`` maps the files into memory (where the folder is on a mounted file system; elsewhere it reads
them) and returns rows per document.

Only a row per shard leaves the tasks. A task writes under a name of its own attempt and renames at the end, so a
lost executor or a second attempt leaves either the whole file or none.

Edge cases: a NULL text is empty and yields the end id alone; NULL ids sort first and are stored as -2**63, which
reads back as NULL; repeated ids keep all their rows, ordered by text; an empty table yields no shard and no row.
Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, ship, text_or_empty
from tidemark.llm.encode import encoder, slices, vocabulary_size

NULL_ID = -(2**63)
SHARD_SCHEMA = "shard int, n_docs long, n_tokens long"


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


class _Published:
    """A file written under an attempt's own name and renamed when complete."""

    def __init__(self, fs: pafs.FileSystem, path: str, attempt: int):
        self.fs, self.path, self.temp = fs, path, f"{path}.{attempt}"
        self.out = fs.open_output_stream(self.temp)

    def write(self, data) -> None:
        self.out.write(data)

    def publish(self) -> None:
        self.out.close()
        if not isinstance(self.fs, pafs.LocalFileSystem) and self.fs.get_file_info(self.path).type != pafs.FileType.NotFound:
            self.fs.delete_file(self.path)
        self.fs.move(self.temp, self.path)


def id_type(ids: int) -> str:
    """The narrowest of the two file types that holds ids 0..ids-1."""
    return "<u2" if ids <= 1 << 16 else "<u4"


def _load(fs: pafs.FileSystem, path: str, dtype: str) -> np.ndarray:
    if isinstance(fs, pafs.LocalFileSystem):
        size = fs.get_file_info(path).size
        return np.memmap(path, dtype=dtype, mode="r") if size else np.empty(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, *, end_id: int = 2, units: str = "whole",
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text of ``docs`` into token files in ``folder`` (new, on a shared file system)."""
    spark = docs.sparkSession
    ship(spark)
    end = np.asarray([end_id], dtype="<u4").tobytes()
    width = id_type(max(vocabulary_size(tokenizer), end_id + 1))

    def write_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        shard, attempt = ctx.partitionId(), ctx.taskAttemptId()
        fs, root = _open(folder)
        enc, ids_file, lengths, doc_ids = encoder(tokenizer, units), None, [], []
        for batch in batches:
            texts = batch.column(1).to_pylist()
            doc_ids.append(np.asarray(batch.column(0), dtype="<i8"))
            for a, b in slices(texts):
                if ids_file is None:
                    fs.create_dir(root, recursive=True)
                    ids_file = _Published(fs, f"{root}/shard-{shard:06d}.ids", attempt)
                coded = [c + end for c in enc.encode(texts[a:b])]
                ids_file.write(np.frombuffer(b"".join(coded), dtype="<u4").astype(width).tobytes())
                lengths.extend(len(c) // 4 for c in coded)
        if ids_file is None:
            return
        ids_file.publish()
        for name, data in (("docs", np.concatenate(doc_ids)), ("offsets", np.cumsum([0, *lengths], dtype="<u8"))):
            f = _Published(fs, f"{root}/shard-{shard:06d}.{name}", attempt)
            f.write(data.tobytes())
            f.publish()
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()),
                                          "n_docs": pa.array([len(lengths)], pa.int64()),
                                          "n_tokens": pa.array([int(sum(lengths))], pa.int64())})

    ordered = (docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
                           text_or_empty(text_col).alias("text"))
               .repartitionByRange(F.col("id")).sortWithinPartitions("id", "text"))
    ordered.mapInArrow(write_shard, SHARD_SCHEMA).write.parquet(f"{folder}/shards")

    # One row per shard: a window over them is small whatever the input.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = spark.read.schema(SHARD_SCHEMA).parquet(f"{folder}/shards").withColumn(
        "base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def add_base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        fs, root = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                path = f"{root}/shard-{row['shard']:06d}.offsets"
                local = np.array(_load(fs, path, "<u8"))
                # From the file's own first entry: a second attempt finds the base added already.
                f = _Published(fs, path, attempt)
                f.write((local - local[0] + np.uint64(row["base"])).astype("<u8").tobytes())
                f.publish()
            yield batch

    (bases.repartition("shard").select("shard", "base", "n_docs", "n_tokens")
     .mapInArrow(add_base, "shard int, base long, n_docs long, n_tokens long").write.parquet(f"{folder}/manifest"))


def read_token_files(spark: SparkSession, folder: str, width: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) read back from the files of ``folder``.

    ``width`` is the type of the ids files (see id_type); ``ids_crc32`` is taken over 32-bit ids whatever it is.
    """
    ship(spark)

    def read_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                path = f"{root}/shard-{row['shard']:06d}"
                ids, docs, offsets = (_load(fs, f"{path}.{n}", t) for n, t in (("ids", width), ("docs", "<i8"), ("offsets", "<u8")))
                at = (offsets - np.uint64(row["base"])).astype(np.int64)
                if len(docs) != row["n_docs"] or at[-1] != len(ids) or len(ids) != row["n_tokens"]:
                    raise ValueError(f"{path}: the files and the manifest disagree")
                for a in range(0, len(docs), 10_000):
                    b = min(a + 10_000, len(docs))
                    crc = [zlib.crc32(ids[at[i]:at[i + 1]].astype("<u4")) for i in range(a, b)]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(docs[a:b], pa.int64(), mask=np.asarray(docs[a:b] == NULL_ID)),
                        "start": pa.array(offsets[a:b].astype(np.int64)),
                        "n_tokens": pa.array(np.diff(at[a:b + 1])),
                        "ids_crc32": pa.array(crc, pa.int64())})

    manifest = spark.read.schema("shard int, base long, n_docs long, n_tokens long").parquet(f"{folder}/manifest")
    return manifest.repartition("shard").mapInArrow(read_shard, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, *, end_id: int = 2, units: str = "whole") -> DataFrame:
    """Write ``docs`` as token files in the shared folder and read them back."""
    folder = scratch(docs.sparkSession, "token-files")
    write_token_files(docs, tokenizer, folder, end_id=end_id, units=units)
    return read_token_files(docs.sparkSession, folder, id_type(max(vocabulary_size(tokenizer), end_id + 1)))
