"""How quality filters interact: what each removes, repeats or loses, in every order of applying them.

Each filter keeps, for each part and range of row numbers, the sorted list of the rows that fail it. Unions and
differences of those lists are merged by galloping: a list leaps over stretches in which the other has nothing. What
a filter removes after others is its list without the union of theirs, so a range yields one row of sums for each
filter and set of filters before it; sums over ranges and the table of all orders give the report.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluxwell.llm.common import settle

FILTERS = "ABCDE"
#: Rows of a range, as a power of two: the most that any list holds.
RANGE = 16
#: Ids that a galloping step places at once.
STEP = 256
UPPER = bytes(range(65, 91))
MARKS = b"#$%&*|"

MEASURED = "row long, doc_id long, part string, digest binary, mask int"
SUMS = "part string, before int, filter string, removed long, redundant long, good long, toxic long"


def measure(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``part``, ``digest`` (of the text) and ``mask`` (filters A to D that fail) of every row."""

    def mask(text: bytes) -> int:
        words, points = text.split(), len(text.decode("utf-8", "replace"))
        upper = len(text) - len(text.translate(None, UPPER))
        marked = len(text) != len(text.translate(None, MARKS))
        return (len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1 | (100 * upper > 3 * points) << 2 | marked << 3

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [x or b"" for x in frame["text"]]
            digests, masks = [hashlib.sha256(x).digest() for x in texts], [mask(x) for x in texts]
            yield pd.DataFrame({"row": frame["row"], "doc_id": frame["doc_id"].astype("Int64"), "part": frame["part"], "digest": digests, "mask": masks})

    part = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), part.alias("part"), F.col("text").cast("binary").alias("text"))
    return settle(rows.mapInPandas(measured, MEASURED), "measured")


def postings(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """Sorted lists of row numbers for each ``part`` and ``range``: one per filter, and ``good`` and ``toxic`` failing ones.

    Filter E fails a row whose text some row with a smaller ``doc_id`` has; rows without an id neither fail nor count. A
    document is good, or toxic, where any of its labels says so.
    """
    first = measured.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).cast("int")
    rows = measured.join(first, "digest", "left").select("row", "doc_id", "part", (F.col("mask") + 16 * again).alias("mask"))
    one = lambda name: F.max((F.col(name) == 1).cast("int")).alias(name)
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(one("quality"), one("toxic"))
    # rows without an id would meet in one task; by their number they do not
    marked = F.coalesce("doc_id", "row") == F.col("label_id")
    marks = marks.withColumn("named", F.lit(True))
    failing = rows.where("mask <> 0").join(marks, marked & (F.col("doc_id").isNotNull() == F.col("named")), "left").withColumnRenamed("quality", "good")
    lists = {name: F.expr(f"(mask & {1 << i}) <> 0") for i, name in enumerate(FILTERS)} | {name: F.col(name) == 1 for name in ("good", "toxic")}
    gathered = [F.sort_array(F.collect_list(F.when(test, F.col("row")))).alias(f"ids_{name}") for name, test in lists.items()]
    return settle(failing.groupBy("part", F.shiftright("row", RANGE).alias("range")).agg(*gathered), "postings")


def places(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Where each of the sorted ``ids`` would stand in the sorted ``others``, by galloping through them."""
    found, at = np.empty(len(ids), dtype=np.int64), 0
    for low in range(0, len(ids), STEP):
        some = ids[low : low + STEP]
        # leap to the stretch of this step's ids: nothing before its first one, all up to its last
        reach = 1
        while at + reach < len(others) and others[at + reach] < some[0]:
            at, reach = at + reach, 2 * reach
        end, reach = at, 1
        while end < len(others) and others[end] <= some[-1]:
            end, reach = min(end + reach, len(others)), 2 * reach
        found[low : low + STEP] = at + np.searchsorted(others[at:end], some)
    return found


def held(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the sorted ``ids`` the sorted ``others`` have."""
    if not len(others):
        return np.zeros(len(ids), dtype=bool)
    at = places(ids, others)
    return others[np.minimum(at, len(others) - 1)] == ids


def union(lists: list[np.ndarray]) -> np.ndarray:
    """All ids of some sorted lists, merged in one after the other, the longest first."""
    lists = sorted(lists, key=len, reverse=True)
    out = lists[0] if lists else np.zeros(0, dtype=np.int64)
    for ids in lists[1:]:
        new = ids[~held(ids, out)]
        out = np.insert(out, places(new, out), new)
    return out


def merge(lists: dict[str, np.ndarray]) -> Iterator[tuple[int, str, int, int, int, int]]:
    """For each filter and set of other filters before it (as a mask): rows removed, redundant, good and toxic removed."""
    for size in range(len(FILTERS)):
        for before in combinations(FILTERS, size):
            gone = union([lists[name] for name in before])
            for name in set(FILTERS).difference(before):
                ids = lists[name]
                removed = ids[~held(ids, gone)]
                lost = [int(held(removed, lists[x]).sum()) for x in ("good", "toxic")]
                yield sum(1 << FILTERS.index(x) for x in before), name, len(removed), len(ids) - len(removed), *lost


def sums(posted: DataFrame) -> DataFrame:
    """Sums over all ranges of a part for each filter and set of filters ``before`` it."""

    def merged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for k, part in enumerate(frame["part"]):
                lists = {name: np.asarray(frame[f"ids_{name}"].iloc[k], dtype=np.int64) for name in (*FILTERS, "good", "toxic")}
                rows += [(part, *x) for x in merge(lists)]
            yield pd.DataFrame(rows, columns=["part", "before", "filter", "removed", "redundant", "good", "toxic"])

    return posted.drop("range").mapInPandas(merged, SUMS)


def orders() -> list[tuple[str, int, str, int, int]]:
    """Every step of every order of the filters: order, step, filter, mask of those before, mask of all others."""
    bit = {name: 1 << i for i, name in enumerate(FILTERS)}
    every = sum(bit.values())
    return [("".join(order), i + 1, name, sum(bit[x] for x in order[:i]), every - bit[name]) for order in permutations(FILTERS) for i, name in enumerate(order)]


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter does at each step of each order, for each part of ``docs``.

    ``docs`` has ``doc_id``, ``text`` and ``lang`` (the part; null is the empty string), ``labels`` ``doc_id``, ``quality``
    and ``toxic``; more columns are ignored. Null and empty texts are one text without words; repeated rows count each.
    Returns ``part``, ``filter_order``, ``step``, and counts ``kept``, ``removed``, ``redundant``, ``unique_fails``,
    ``good_lost``, ``toxic_lost`` and ``shapley`` (removed at any step, over all orders). An empty table has no parts.
    """
    spark = docs.sparkSession
    measured = measure(docs)
    totals = settle(measured.groupBy("part").agg(F.count("*").alias("total")), "totals")
    # a filter that fails nothing in a part has no list there
    empty = {name: np.zeros(0, dtype=np.int64) for name in (*FILTERS, "good", "toxic")}
    none = F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip(("before", "filter"), x, strict=False))) for x in merge(empty)))
    zero = [F.lit(0).cast("long").alias(c) for c in ("removed", "redundant", "good", "toxic")]
    every = sums(postings(measured, labels)).unionByName(totals.select("part", F.inline(none)).select("*", *zero))
    found = every.groupBy("part", "before", "filter").agg(*(F.sum(c).alias(c) for c in ("removed", "redundant", "good", "toxic")))
    found = settle(found.join(totals, "part"), "sums")
    steps = spark.createDataFrame(orders(), "filter_order string, step int, filter string, before int, others int")
    alone = found.select("part", "filter", F.col("before").alias("others"), F.col("removed").alias("unique_fails"))
    table = found.join(F.broadcast(steps), ["filter", "before"]).join(alone, ["part", "filter", "others"])
    gone = F.sum("removed").over(Window.partitionBy("part", "filter_order").orderBy("step"))
    shapley = F.sum("removed").over(Window.partitionBy("part", "filter"))
    table = table.withColumn("kept", F.col("total") - gone).withColumn("shapley", shapley)
    lost = [F.col(c).alias(f"{c}_lost") for c in ("good", "toxic")]
    return table.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *lost, "shapley")
