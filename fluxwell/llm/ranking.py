"""Ranked lexical search, exact, with hashed max-sketches as upper bounds.

The index keeps for each document its terms with their counts, and a sketch: every term hashes to one of ``WIDTH``
coordinates, which keeps the largest count that falls on it. A term's impact grows with its count, so the impact of a
coordinate bounds that of each of its terms from above. Bounds of a block of documents for all queries at once are
one product of two matrices. A task then scores documents exactly in the order of falling bounds, until no bound
reaches the worst of the best that it has found.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluxwell.llm.common import settle

TOP = 50
#: Coordinates of a sketch.
WIDTH = 1024
#: Counts take one byte in a sketch; this one stands for itself and all larger ones.
MOST = 255
#: Queries that one pass over the index answers, and the characters that they may have together.
QUERIES, QUERY_CHARS = 512, 4_000_000
#: Documents whose bounds are computed at once.
BLOCK = 2048
#: No impact reaches this one, which a term's impact nears as its count grows.
LIMIT = 1_000_000
#: Terms whose coordinates a task remembers.
KEPT_TERMS = 500_000

INDEX = "row long, doc_id long, n long, terms binary, counts binary, sketch binary"
BEST = "query long, doc_id long, row long, score long, part int"
#: What stands between terms: every ASCII byte but letters and digits. All other bytes belong to terms.
BETWEEN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text, in order: runs of letters, digits and all that is not ASCII, with only A-Z lower-cased."""
    return text.lower().translate(BETWEEN).split() if text else []


def index(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The index of all of ``docs`` (``doc_id``, ``text``; more columns are ignored), as a written table.

    One row per row: ``row`` (unique), ``doc_id``, ``n`` (terms with repeats), ``terms`` (distinct ones, joined by
    blanks), ``counts`` (theirs, as 32-bit integers) and ``sketch`` (``width`` coordinates). Null and empty texts have no terms.
    """

    def indexed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places: dict[bytes, int] = {}
        for frame in frames:
            ns, terms, counts, sketches = [], [], [], []
            for text in frame["text"]:
                own: dict[bytes, int] = {}
                for term in terms_of(text):
                    own[term] = own.get(term, 0) + 1
                tf = np.fromiter(own.values(), dtype="<u4", count=len(own))
                for term in own:
                    if term not in places:
                        places[term] = xxhash.xxh64_intdigest(term) % width
                at = np.fromiter(map(places.__getitem__, own), dtype=np.int64, count=len(own))
                sketch = np.zeros(width, np.uint8)
                np.maximum.at(sketch, at, np.minimum(tf, MOST).astype(np.uint8))
                ns.append(int(tf.sum(dtype=np.int64)))
                terms.append(b" ".join(own))
                counts.append(tf.tobytes())
                sketches.append(sketch.tobytes())
                if len(places) > KEPT_TERMS:
                    places.clear()
            yield pd.DataFrame({"row": frame["row"], "doc_id": frame["doc_id"].astype("Int64"), "n": ns, "terms": terms, "counts": counts, "sketch": sketches})

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return settle(rows.mapInPandas(indexed, INDEX), "ranking")


def weight(documents: int, holding: int) -> int:
    return floor(1000 * log((2 * documents + 2) / (2 * holding + 1)))


def impact(tf, m):
    """What a term that occurs ``tf`` times adds to a score, before its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def holding(indexed: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """How many documents of the index hold each of the ``wanted`` terms."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[bytes, int] = {}
        for frame in frames:
            for terms in frame["terms"]:
                for term in wanted.intersection(terms.split(b" ")):
                    total[term] = total.get(term, 0) + 1
        yield pd.DataFrame({"term": list(total), "n": list(total.values())})

    found = indexed.select("terms").mapInPandas(counted, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {bytes(r["term"]): r["n"] for r in found.collect()}


def best_of_parts(indexed: DataFrame, queries: list[tuple[int, dict[bytes, int]]], documents: int, length: int, top: int, width: int, block: int) -> DataFrame:
    """The ``top`` best documents of each task for each query (number, weights of its terms)."""
    lookup = np.zeros((width, len(queries)))
    for q, (_, weights) in enumerate(queries):
        for term, w in weights.items():
            lookup[xxhash.xxh64_intdigest(term) % width, q] += w

    def searched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # of each query: exact scores as (score, -(no id), -id, -row), the worst of the best first
        best: list[list[tuple]] = [[] for _ in queries]
        for frame in frames:
            for low in range(0, len(frame), block):
                _search_block(frame.iloc[low : low + block], queries, lookup, documents, length, top, best)
        part = TaskContext.get().partitionId()
        rows = [(queries[q][0], None if key[1] else -key[2], -key[3], key[0], part) for q, found in enumerate(best) for key in found]
        yield pd.DataFrame(rows, columns=["query", "doc_id", "row", "score", "part"]).astype({"doc_id": "Int64"})

    return indexed.mapInPandas(searched, BEST)


def _search_block(frame: pd.DataFrame, queries: list, lookup: np.ndarray, documents: int, length: int, top: int, best: list[list[tuple]]) -> None:
    ids, rows = [None if pd.isna(x) else int(x) for x in frame["doc_id"]], frame["row"].tolist()
    # Python's own integers: a long text times many documents may pass 64 bits
    ms = [50 + (50 * n * documents) // length for n in frame["n"].tolist()]
    codes = np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(len(frame), len(lookup)).astype(np.int64)
    m = np.array([min(x, 1 << 40) for x in ms], dtype=np.int64)[:, None]
    impacts = np.where(codes == MOST, LIMIT, impact(codes, m)).astype(float)
    # all are whole numbers far below 2 ** 53, so the product is exact
    bounds = impacts @ lookup
    terms, counts, held = frame["terms"].tolist(), frame["counts"].tolist(), {}
    for q, (_, weights) in enumerate(queries):
        found, own = best[q], bounds[:, q]
        least = found[0][0] if len(found) == top else 1
        rest = np.flatnonzero(own >= least)
        fresh = list(found)
        for at in rest[np.argsort(-own[rest], kind="stable")].tolist():
            if own[at] < least:
                break
            if at not in held:
                held[at] = dict(zip(terms[at].split(b" "), np.frombuffer(counts[at], "<u4").tolist(), strict=False))
            has = held[at]
            score = sum(w * impact(has[t], ms[at]) for t, w in weights.items() if t in has)
            if score >= least:
                fresh.append((score, -(ids[at] is None), 0 if ids[at] is None else -ids[at], -rows[at]))
                if len(fresh) >= 2 * top:
                    fresh = sorted(fresh)[-top:]
                    least = max(least, fresh[0][0])
        best[q] = sorted(fresh)[-top:]


def _batches(queries: DataFrame, most: int) -> Iterator[DataFrame]:
    """Numbered queries in batches of at most ``most`` rows and about ``QUERY_CHARS`` characters."""
    part, size = F.shiftright("query", 33), F.coalesce(F.length("text"), F.lit(0)).cast("long")
    sized = queries.withColumn("part", part).withColumn("size", size)
    # one row per partition of the table: what lies before it
    rows, chars, before = 0, 0, []
    for r in sized.groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("size")).orderBy("part").collect():
        before.append((r["part"], rows, chars))
        rows, chars = rows + r["n"], chars + r["size"]
    starts = queries.sparkSession.createDataFrame(before, "part long, rows long, chars long")
    order = Window.partitionBy("part").orderBy("query")
    number, passed = F.col("rows") + F.row_number().over(order) - 1, F.col("chars") + F.sum("size").over(order) - F.col("size")
    cut = sized.join(starts, "part").withColumn("a", F.floor(number / most)).withColumn("b", F.floor(passed / QUERY_CHARS))
    cut = settle(cut.select("query", "item_id", "text", "a", "b"), "queries")
    for r in cut.select("a", "b").distinct().orderBy("a", "b").toLocalIterator():
        yield cut.where((F.col("a") == r["a"]) & (F.col("b") == r["b"]))


def search(indexed: DataFrame, items: DataFrame, top: int = TOP, batch_rows: int = QUERIES, block: int = BLOCK) -> DataFrame:
    """The ``top`` best documents of an :func:`index` for every row of ``items`` (``item_id``, ``text``).

    Returns ``item_id``, ``rank`` (from 1, unique), ``doc_id`` and ``score`` of documents with a score above 0, equal
    scores by ascending ``doc_id``, rows without one last. Every row of ``items`` is a query of its own, also where ids
    repeat or are null; a null text asks for nothing. Documents that repeat are ranked each. Queries go to the tasks
    in batches of ``batch_rows`` at most; a query's weights count its distinct terms once.
    """
    spark = indexed.sparkSession
    sums = indexed.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("length"), F.max(F.length("sketch")).alias("width")).first()
    numbered = settle(items.select(F.monotonically_increasing_id().alias("query"), "item_id", F.col("text").cast("string").alias("text")), "items")
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    if not sums["length"]:
        return out
    for batch in _batches(numbered, batch_rows):
        asked = {r["query"]: set(terms_of((r["text"] or "").encode())) for r in batch.select("query", "text").collect()}
        asked = {q: terms for q, terms in asked.items() if terms}
        if not asked:
            continue
        df = holding(indexed, set().union(*asked.values()))
        weights = [(q, {t: weight(sums["documents"], df[t]) for t in terms if t in df}) for q, terms in asked.items()]
        found = settle(best_of_parts(indexed, weights, sums["documents"], sums["length"], top, sums["width"], block), "best")
        order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
        # first within some tasks, so that no task ranks what all tasks found for a query
        some = Window.partitionBy("query", F.pmod("part", F.lit(64))).orderBy(*order)
        less = found.withColumn("k", F.row_number().over(some)).where(F.col("k") <= top).drop("k")
        ranked = less.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= top)
        named = batch.select(F.col("query").alias("own_query"), "item_id")
        met = ranked.join(named, F.col("query") == F.col("own_query"))
        out = out.unionByName(met.select("item_id", F.col("rank").cast("int"), "doc_id", "score"))
    return out
