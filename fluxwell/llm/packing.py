"""Best-fit packing of documents into sequences of a fixed number of tokens.

Bulk-synchronous rounds: documents that fit no gap open sequences; documents and gaps are sorted together
into ranges of sizes; each range is swept from large to small, and a document takes the smallest gap that
holds it; what a range leaves over is matched with gaps of larger ranges by rank; gaps shrink, and the next
round begins. A round moves a few numbers per document, never token ids. Rounds are the same at every size; a
small table is one range.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import count
from math import ceil

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxwell.llm import tokens
from fluxwell.llm.common import settle

CAPACITY = 1024
END_ID = 2
#: Documents and gaps that one task sweeps.
SWEEP_ROWS = 40_000

PIECES = "piece_id long, doc_id long, piece int, start long, length long, ids_crc32 long"
PIECES_WITH_IDS = PIECES + ", ids binary"
SWEPT = "part int, rank long, kind string, id long, size long, offset long, bin long"


def cut(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every row of ``docs`` (``doc_id``, ``text``; more columns are ignored).

    A document's tokens are the ids of its text and ``end_id``; a null text is empty, so it has one token.
    Only documents longer than ``capacity`` are cut, and only their first piece may be shorter than it.
    Repeated rows are documents of their own; a null ``doc_id`` stays null. With ``with_ids`` the ids come
    along as little-endian unsigned 32-bit integers.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = tokens.encoder(vocabulary)
        number = TaskContext.get().partitionId() << 36
        for frame in frames:
            ids, texts = frame["doc_id"].tolist(), frame["text"].tolist()
            for i, j in tokens.batches(texts):
                rows = []
                for doc, raw in zip(ids[i:j], encoder.encode(texts[i:j]), strict=True):
                    raw += end
                    total = len(raw) // 4
                    first = total % capacity or capacity
                    for piece, to in enumerate(range(first, total + 1, capacity)):
                        at = max(0, to - capacity) if piece else 0
                        part = raw[4 * at : 4 * to]
                        rows.append((number, doc, piece, at, to - at, zlib.crc32(part), *([part] if with_ids else [])))
                        number += 1
                out = pd.DataFrame(rows, columns=["piece_id", "doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])
                yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(pieces, PIECES_WITH_IDS if with_ids else PIECES)


def sweep(sizes: list[int], kinds: list[int], ids: list[int], capacity: int) -> tuple[list, list, list]:
    """Best fit over one range, sorted from large to small with gaps (0) before documents (1) of their size.

    A document without a gap is left over. Returns placements (document, sequence, offset), gaps left (sequence, size) from small to large, and
    documents left (document, size) from large to small.
    """
    free: dict[int, list[int]] = {}
    order: list[int] = []
    placed, left = [], []
    for size, kind, item in zip(sizes, kinds, ids, strict=True):
        if kind == 1:
            at = bisect_left(order, size)
            if at < len(order):
                gap = order[at]
                bins = free[gap]
                target = bins.pop()
                if not bins:
                    del free[gap], order[at]
            else:
                left.append((item, size))
                continue
            placed.append((item, target, capacity - gap))
            size, item = gap - size, target
        if size:
            if size in free:
                free[size].append(item)
            else:
                free[size] = [item]
                insort(order, size)
    return placed, [(b, g) for g in order for b in free[g]], left


def _sweep_ranges(items: DataFrame, parts: int, capacity: int) -> DataFrame:
    """Sort documents and gaps into ranges and sweep each range on its own."""

    def swept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames), ignore_index=True)
        if rows.empty:
            return
        part = TaskContext.get().partitionId()
        sizes = rows["size"].tolist()
        placed, gaps, left = sweep(sizes, rows["kind"].tolist(), rows["id"].tolist(), capacity)
        # a gap that has shrunk below this range may be too small for documents of the next ones
        ready = iter(range(len(gaps)))
        out = [(part, -1, "placed", d, 0, at, b) for d, b, at in placed]
        out += [(part, next(ready) if g >= sizes[-1] else -1, "gap", b, g, 0, 0) for b, g in gaps]
        out += [(part, i, "doc", d, n, 0, 0) for i, (d, n) in enumerate(left)]
        yield pd.DataFrame(out, columns=["part", "rank", "kind", "id", "size", "offset", "bin"])

    order = [F.desc("size"), F.col("kind"), F.xxhash64("id")]
    return items.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInPandas(swept, SWEPT)


def match_ranks(docs: dict[int, int], gaps: dict[int, int]) -> list[tuple[int, int, int, int, int]]:
    """Match counts of documents left with counts of gaps left in larger ranges, nearest range first.

    Returns (range of documents, first rank, last rank + 1, range of gaps, first rank there).
    """
    stack: list[list[int]] = []
    found = []
    for part in sorted(docs.keys() | gaps.keys()):
        at, count = 0, docs.get(part, 0)
        while at < count and stack:
            top = stack[-1]
            n = min(count - at, top[1] - top[2])
            found.append((part, at, at + n, top[0], top[2]))
            at += n
            top[2] += n
            if top[2] == top[1]:
                stack.pop()
        if gaps.get(part, 0):
            stack.append([part, gaps[part], 0])
    return found


def opening(lengths: dict[int, int], gaps: dict[int, int], capacity: int) -> dict[int, float]:
    """The share of the documents of each length that open a sequence, from counts by length and by gap.

    Best fit over the counts, longest documents first: equal documents go into equal gaps at once, and those
    that find no gap open sequences. It only tells how many; the sweeps decide which document goes where.
    """
    free, order = dict(gaps), sorted(gaps)
    shares = {}

    def room(gap: int, count: int) -> None:
        if gap > 0:
            if gap not in free:
                insort(order, gap)
            free[gap] = free.get(gap, 0) + count

    for n in sorted(lengths, reverse=True):
        left, opened = lengths[n], 0
        while left:
            at = bisect_left(order, n)
            if at == len(order):
                # as many as the rest needs, then those are filled
                opening_now = -(-left // max(1, capacity // n))
                opened += opening_now
                left -= opening_now
                room(capacity - n, opening_now)
                continue
            gap = order[at]
            some = min(left, free[gap])
            left -= some
            free[gap] -= some
            if not free[gap]:
                del free[gap], order[at]
            room(gap - n, some)
        if opened:
            shares[n] = opened / lengths[n]
    return shares


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Place every row of ``pieces`` (``piece_id`` unique, ``length`` from 1 to ``capacity``) in a sequence.

    Adds ``sequence_id`` (the ``piece_id`` that opened the sequence) and ``offset``; a sequence has no holes
    before its end. No rows give no rows; equal lengths are told apart by a hash of ``piece_id``. Counts by
    length and by range, at most ``2 * capacity`` and two per range, are all that reaches the driver.
    """
    spark = pieces.sparkSession
    placed: list[DataFrame] = [pieces.where(F.col("length") >= capacity).select(F.col("piece_id").alias("id"), F.col("piece_id").alias("bin"), F.lit(0).cast("long").alias("offset"))]
    docs = pieces.where(F.col("length") < capacity).select(F.col("piece_id").alias("id"), F.col("length").alias("size"))
    gaps = spark.createDataFrame([], "id long, size long")
    left_now = None
    for turn in count():
        state = docs.select(F.lit(1).alias("kind"), "size").union(gaps.select(F.lit(0), "size"))
        counts = {(r["kind"], r["size"]): r["n"] for r in state.groupBy("kind", "size").agg(F.count("*").alias("n")).collect()}
        lengths, room = ({n: c for (kind, n), c in counts.items() if kind == k} for k in (1, 0))
        if not lengths:
            break
        # gaps that hold no document any more leave the table
        room = {g: n for g, n in room.items() if g >= min(lengths)}
        gaps = gaps.where(F.col("size") >= min(lengths))
        parts = max(1, ceil((sum(lengths.values()) + sum(room.values())) / SWEEP_ROWS))
        shares = opening(lengths, room, capacity)
        left_before, left_now = left_now, sum(lengths.values())
        if left_now == left_before and shares:
            # chance opened no sequence and no gap took a document: the longest ones that need a sequence open one each
            shares[max(shares)] = 1.0
        if shares:
            lot = F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(1_000_003)) / F.lit(1_000_003.0)
            share = F.element_at(F.create_map(*(F.lit(x) for n, x in shares.items() for x in (int(n), float(x)))), F.col("size").cast("int"))
            marked = docs.withColumn("opens", F.coalesce(lot < share, F.lit(False)))
            opened = marked.where("opens").select("id", "size")
            placed.append(opened.select("id", F.col("id").alias("bin"), F.lit(0).cast("long").alias("offset")))
            gaps = gaps.union(opened.select("id", (F.lit(capacity) - F.col("size")).alias("size")))
            docs = marked.where("NOT opens").select("id", "size")
        items = docs.select(F.lit(1).alias("kind"), "id", "size").union(gaps.select(F.lit(0), "id", "size"))
        swept = settle(_sweep_ranges(items, parts, capacity), "swept")
        placed.append(swept.where("kind = 'placed'").select("id", "bin", "offset"))
        left = {(r["kind"], r["part"]): r["n"] for r in swept.where("kind <> 'placed' AND rank >= 0").groupBy("kind", "part").agg(F.count("*").alias("n")).collect()}
        found = match_ranks(*({p: n for (kind, p), n in left.items() if kind == k} for k in ("doc", "gap")))
        docs = swept.where("kind = 'doc'").select("id", "size")
        gaps = swept.where("kind = 'gap'").select("id", "size")
        if found:
            plan = spark.createDataFrame(found, "part int, low long, high long, gap_part int, gap_low long")
            own = swept.where("kind = 'doc'").join(plan, "part").where("rank >= low AND rank < high")
            own = own.select("id", "size", "gap_part", (F.col("rank") - F.col("low") + F.col("gap_low")).alias("gap_rank"))
            room = swept.where("kind = 'gap' AND rank >= 0").select(F.col("part").alias("gap_part"), F.col("rank").alias("gap_rank"), F.col("id").alias("bin"), F.col("size").alias("gap"))
            pairs = settle(own.join(room, ["gap_part", "gap_rank"]).select("id", "size", "bin", "gap"), "pairs")
            placed.append(pairs.select("id", "bin", (F.lit(capacity) - F.col("gap")).alias("offset")))
            docs = docs.join(pairs.select("id"), "id", "left_anti")
            used = pairs.select(F.col("bin").alias("id"), (F.col("gap") - F.col("size")).alias("size"))
            gaps = gaps.join(used.select("id"), "id", "left_anti").union(used.where("size > 0"))
    every = placed[0]
    for more in placed[1:]:
        every = every.unionByName(more)
    every = every.select(F.col("id").alias("piece_id"), F.col("bin").alias("sequence_id"), "offset")
    return pieces.join(every, "piece_id")


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Cut and pack all of ``docs``; see :func:`cut` and :func:`pack` for columns and odd inputs."""
    pieces = settle(cut(docs, vocabulary or tokens.vocabulary(), capacity, end_id), "pieces")
    return pack(pieces, capacity).drop("piece_id")


def sequences(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed token ids: ``sequence_id``, ``length``, ``ids`` (binary), ``doc_starts`` (offsets of pieces).

    A group holds at most ``capacity`` tokens, whatever the input.
    """
    pieces = settle(cut(docs, vocabulary or tokens.vocabulary(), capacity, end_id, with_ids=True), "pieces")
    parts = pack(pieces, capacity).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("parts"))
    join = F.aggregate("parts.ids", F.lit(b""), lambda done, ids: F.concat(done, ids))
    return parts.select("sequence_id", F.aggregate("parts.length", F.lit(0).cast("long"), lambda a, b: a + b).alias("length"), join.alias("ids"), F.col("parts.offset").alias("doc_starts"))
