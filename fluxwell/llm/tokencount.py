"""Token counts of documents from flat token files without an index.

A file is nothing but token ids, each document closed by an end-of-document id. Files are cut into blocks
whatever their contents; each block is searched for the end id at once, and a prefix scan over the blocks of
a file joins the documents that run across blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluxwell.llm import tokens
from fluxwell.llm.common import new_path, settle
from fluxwell.llm.tokenfiles import _make_folder, open_file

#: Ids in a block.
BLOCK = 1 << 22
#: Fixed value: the end-of-document id of the vocabulary; no text encodes to it.
END_ID = 50256
WRITTEN = "path string, ordinal long, doc_id long, n_ids long"
FOUND = "path string, block long, i long, at long"


def write(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, folder: str | None = None) -> DataFrame:
    """Write one flat file of ids per partition of ``docs`` (``doc_id``, ``text``), of two bytes each where the vocabulary allows.

    Returns which document stands where: ``path``, ``ordinal`` in the file, ``doc_id``, and ``n_ids``, the
    ids in the file up to the end of the batch that wrote it. A null text is empty; a null ``doc_id`` stays null.
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "flat")
    name = vocabulary or tokens.vocabulary()
    end, kind = np.array([end_id], dtype="<u4").tobytes(), tokens.id_type(name)

    def written(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, out, done, size = tokens.encoder(name, plain=True), None, 0, 0
        uri = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        for frame in frames:
            texts = frame["text"].tolist()
            for i, j in tokens.batches(texts):
                if out is None:
                    store, path = fs.FileSystem.from_uri(uri)
                    out = store.open_output_stream(path)
                for ids in encoder.encode(texts[i:j]):
                    out.write(np.frombuffer(ids + end, dtype="<u4").astype(kind).tobytes())
                    size += len(ids) // 4 + 1
                yield pd.DataFrame({"path": uri, "ordinal": np.arange(done, done + j - i), "doc_id": frame["doc_id"].iloc[i:j].astype("Int64").to_numpy(), "n_ids": size})
                done += j - i
        if out is not None:
            out.close()

    _make_folder(spark, folder)
    return settle(docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(written, WRITTEN), "written")


def scan(files: DataFrame, end_id: int = END_ID, block: int = BLOCK, kind: str = "<u2") -> DataFrame:
    """Documents of flat files, in order: ``path``, ``ordinal``, ``n_tokens`` (without the end id).

    ``files`` has ``path`` and ``n_ids``; ``kind`` is the type of their ids (``tokens.id_type``). Ids after the last end id belong to no document. A file without ids
    has no documents.
    """

    width = np.dtype(kind).itemsize

    def searched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, number, n in zip(frame["path"], frame["block"], frame["n_ids"], strict=True):
                start = int(number) * block
                with open_file(path) as file:
                    file.seek(width * start)
                    ids = np.frombuffer(file.read(width * min(block, int(n) - start)), dtype=kind)
                ends = np.flatnonzero(ids == end_id)
                if len(ends):
                    yield pd.DataFrame({"path": path, "block": number, "i": np.arange(len(ends)), "at": start + ends})

    blocks = files.select("path", "n_ids", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n_ids") / block) - 1, F.lit(0)))).alias("block"))
    found = settle(blocks.repartition("path", "block").mapInPandas(searched, FOUND), "found")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = found.groupBy("path", "block").agg(F.count("*").alias("n"), F.max("at").alias("last"))
    carried = sums.select("path", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.coalesce(F.max("last").over(before), F.lit(-1)).alias("previous"))
    inner = Window.partitionBy("path", "block").orderBy("i")
    gaps = found.withColumn("own", F.lag("at").over(inner)).join(carried, ["path", "block"])
    return gaps.select("path", (F.col("base") + F.col("i")).alias("ordinal"), (F.col("at") - F.coalesce("own", "previous") - 1).alias("n_tokens"))


def count_tokens(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every row of ``docs``; more columns are ignored, repeated rows count each."""
    written = write(docs, vocabulary, end_id)
    files = written.groupBy("path").agg(F.max("n_ids").alias("n_ids"))
    return written.select("path", "ordinal", "doc_id").join(scan(files, end_id, kind=tokens.id_type(vocabulary or tokens.vocabulary())), ["path", "ordinal"]).select("doc_id", "n_tokens")
