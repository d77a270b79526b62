"""Token ids in Arrow stream files of equal-length sequences.

A record batch has the columns ``ids``, ``mask`` and ``last``, all fixed-size lists: a sequence's token ids,
which of them are real, and which end a document. Fixed-size lists lie in one buffer, so sequence ``k`` of a
file is a slice of a memory map: nothing is parsed or copied. A second stream lists the documents' ids.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluxwell.llm import tokens
from fluxwell.llm.common import new_path, settle

SEQUENCE = 2048
#: Sequences in a full record batch.
BATCH = 256
MANIFEST = "part int, path string, n_docs long, n_ids long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def schema_of(length: int, vocabulary_size: int) -> pa.Schema:
    """Ids take two bytes where the vocabulary allows."""
    ids = pa.uint16() if vocabulary_size <= 1 << 16 else pa.uint32()
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length)), ("last", pa.list_(pa.bool_(), length))])


def open_file(uri: str) -> pa.NativeFile:
    """A file of any store that Arrow knows; local files are memory-mapped."""
    store, path = fs.FileSystem.from_uri(uri)
    return pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)


class Writer:
    """Writes documents one after the other into one pair of files."""

    def __init__(self, uri: str, length: int, vocabulary_size: int):
        store, path = fs.FileSystem.from_uri(uri)
        self.length, self.schema = length, schema_of(length, vocabulary_size)
        self.dtype = self.schema.field("ids").type.value_type.to_pandas_dtype()
        self.files = [store.open_output_stream(path + x) for x in (".ids", ".docs")]
        self.ids = pa.ipc.new_stream(self.files[0], self.schema)
        self.docs = pa.ipc.new_stream(self.files[1], pa.schema([("doc_id", pa.int64())]))
        self.waiting: list[np.ndarray] = []
        self.ends: list[int] = []
        self.held = self.n_ids = self.n_docs = 0

    def add(self, doc_ids: list, raws: list[bytes], end: bytes) -> None:
        """Documents with their ids as little-endian unsigned 32-bit integers, each to be closed by ``end``."""
        ids = np.frombuffer(end.join([*raws, b""]), dtype="<u4").astype(self.dtype)
        self.ends += (self.held - 1 + np.cumsum([len(x) // 4 + 1 for x in raws])).tolist()
        self.waiting.append(ids)
        self.held += len(ids)
        self.n_ids += len(ids)
        if self.held >= BATCH * self.length:
            self._flush(self.held - self.held % (BATCH * self.length))
        self.docs.write_batch(pa.record_batch([pa.array(doc_ids, pa.int64())], names=["doc_id"]))
        self.n_docs += len(doc_ids)

    def _flush(self, count: int) -> None:
        """Write ``count`` ids, padded to whole sequences."""
        flat = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.dtype)
        ends = np.array(self.ends, dtype=np.int64)
        size = -(-count // self.length) * self.length
        ids, mask, last = np.zeros(size, self.dtype), np.zeros(size, bool), np.zeros(size, bool)
        ids[:count], mask[:count], last[ends[ends < count]] = flat[:count], True, True
        step = BATCH * self.length
        for at in range(0, size, step):
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x[at : at + step]), self.length) for x in (ids, mask, last)]
            self.ids.write_batch(pa.record_batch(columns, schema=self.schema))
        self.waiting, self.held = [flat[count:]], len(flat) - count
        self.ends = (ends[ends >= count] - count).tolist()

    def close(self) -> None:
        if self.held:
            self._flush(self.held)
        for x in (self.ids, self.docs, *self.files):
            x.close()


class Sequences:
    """Random access to the sequences of a file; arrays are views of the mapped file."""

    def __init__(self, uri: str):
        with pa.ipc.open_stream(open_file(uri + ".ids")) as reader:
            self.batches = list(reader)

    def __len__(self) -> int:
        return sum(len(x) for x in self.batches)

    def __getitem__(self, k: int) -> tuple[np.ndarray, pa.Array]:
        batch, row = self.batches[k // BATCH], k % BATCH
        size = batch.schema.field("ids").type.list_size
        ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True)[row * size : (row + 1) * size]
        return ids, batch.column("mask").flatten().slice(row * size, size)


def write(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0, length: int = SEQUENCE, folder: str | None = None) -> DataFrame:
    """Encode all of ``docs`` (``doc_id``, ``text``; more columns are ignored) into files in ascending ``doc_id`` order.

    Returns the manifest: ``part`` (order of files), ``path``, ``n_docs``, ``n_ids``. A null text is empty and
    has the end id alone; null ids come first; rows that repeat an id stand in the order of a hash of their text, and
    one id's rows may fill several files. No rows give an empty manifest.
    A task that runs twice leaves a file that no manifest names.
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")
    name = vocabulary or tokens.vocabulary()
    end = np.array([end_id], dtype="<u4").tobytes()

    def written(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, encoder = None, tokens.encoder(name)
        uri = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        for frame in frames:
            ids, texts = [None if pd.isna(x) else int(x) for x in frame["doc_id"]], frame["text"].tolist()
            for i, j in tokens.batches(texts):
                writer = writer or Writer(uri, length, encoder.tokenizer.get_vocab_size())
                writer.add(ids[i:j], encoder.encode(texts[i:j]), end)
        if writer:
            writer.close()
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "path": [uri], "n_docs": [writer.n_docs], "n_ids": [writer.n_ids]})

    _make_folder(spark, folder)
    order = ["doc_id", F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(*order).sortWithinPartitions(*order)
    return settle(rows.mapInPandas(written, MANIFEST), "manifest")


def _make_folder(spark: SparkSession, folder: str) -> None:
    """Create the folder of the files through Arrow, as the writers do."""
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)


def read(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: ``doc_id``, ``start``, ``n_tokens`` (with the end id), ``ids_crc32``."""
    files = manifest.select("part", "path", F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))

    def documents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, base in zip(frame["path"], frame["base"], strict=True):
                yield from _documents(path, int(base))

    return files.repartition(max(1, manifest.count()), "part").mapInPandas(documents, DOCS)


def _documents(path: str, base: int) -> Iterator[pd.DataFrame]:
    with pa.ipc.open_stream(open_file(path + ".docs")) as reader:
        names = reader.read_all().column("doc_id").to_pylist()
    done, crc, at, start = 0, 0, base, base
    with pa.ipc.open_stream(open_file(path + ".ids")) as reader:
        for batch in reader:
            mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
            real = int(mask.sum())  # padding only stands at the end
            ids = batch.column("ids").flatten().to_numpy()[:real]
            ends = np.flatnonzero(batch.column("last").flatten().to_numpy(zero_copy_only=False)[:real]) + 1
            wide, low, rows = ids.astype("<u4").tobytes(), 0, []
            for high in ends.tolist():
                crc = zlib.crc32(wide[4 * low : 4 * high], crc)
                rows.append((names[done], start, at + high - start, crc))
                done, crc, start, low = done + 1, 0, at + high, high
            crc = zlib.crc32(wide[4 * low :], crc)
            at += real
            yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})
