"""Near-duplicates by SimHash, found exactly with vantage-point trees.

Two fingerprints of 64 bits that differ in at most ``k`` bits differ in at most ``k // 2`` bits of one half.
Each half has a tree of its own: an inner node holds a vantage fingerprint and a radius, and sends a fingerprint
inside or outside by its Hamming distance. By the triangle inequality only fingerprints within the search
distance of the radius can have neighbours on the other side; these also go to a third branch, the shard that
overlaps the boundary. So each pair meets in some leaf, and a leaf is searched on its own.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxwell.llm import shingles
from fluxwell.llm.common import components, linked_within, settle

SEED = 42
#: Fingerprints from which trees are built; only their balance depends on it, never which pairs are found.
TREE_SAMPLE = 32_768
#: Fingerprints of one crowded leaf from which it gets a tree of its own.
LEAF_SAMPLE = 4096
#: Fingerprints of a crowded leaf that one task sends down its tree.
PART = 1 << 16
#: Fingerprints that a leaf should hold, and that one search takes; larger leaves are searched block by block.
LEAF = 4096
FULL = (1 << 64) - 1
HALVES = (0xFFFFFFFF, 0xFFFFFFFF00000000)
BIT = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None, words: int = 3) -> int:
    """The SimHash of a text: a bit is set where over half of the hashes of its word shingles have it.

    A-Z are lower-cased, words are runs without ASCII white space. Fewer words than a shingle are one
    shingle; a text without words, and a null, has fingerprint zero.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(b" ".join(parts), SEED)
    counts, total = np.zeros(64, dtype=np.int64), len(parts) - words + 1
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, 8192):
        some = parts[at : at + 8192 + words - 1]
        shingles = map(b" ".join, zip(*(some[i:] for i in range(words)), strict=False))
        hashes = np.fromiter((digest(x, SEED) for x in shingles), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(BIT[2 * counts > total].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id``, ``raw`` (a hash of the text) and ``fp`` (the fingerprint as a signed long) of every row of ``docs``."""

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = np.fromiter((fingerprint(x, words) for x in frame["text"]), dtype=np.uint64, count=len(frame))
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "raw": frame["raw"], "fp": found.view(np.int64)})

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("raw"), "text")
    return rows.mapInPandas(hashed, "doc_id long, raw long, fp long")


@dataclass
class Node:
    """A leaf has a number; an inner node has a vantage fingerprint, a radius and three branches."""

    leaf: int = -1
    vantage: int = 0
    radius: int = 0
    inside: Node | None = None
    outside: Node | None = None
    across: Node | None = None


def build_tree(sample: np.ndarray, mask: int, reach: int, scale: float, leaf: int = LEAF) -> tuple[Node, int]:
    """A tree over a sample of fingerprints, each of which stands for ``scale`` of them, and its count of leaves."""
    random, leaves = np.random.default_rng(SEED), [0]

    def grow(points: np.ndarray) -> Node:
        best = None
        if len(points) * scale > leaf and len(points) >= 16:
            for vantage in random.choice(points, size=min(6, len(points)), replace=False):
                counts = np.bincount(np.bitwise_count((points ^ vantage) & np.uint64(mask)), minlength=66)
                inside = np.cumsum(counts)
                for radius in range(65 - reach):
                    small = min(inside[radius], len(points) - inside[radius])
                    across = inside[radius + reach] - (inside[radius - reach] if radius >= reach else 0)
                    cost = across + abs(len(points) - 2 * inside[radius]) / 2
                    if small >= len(points) / 8 and across <= len(points) * 0.7 and (best is None or cost < best[0]):
                        best = (cost, vantage, radius)
        if best is None:
            leaves[0] += 1
            return Node(leaf=leaves[0] - 1)
        _, vantage, radius = best
        d = np.bitwise_count((points ^ vantage) & np.uint64(mask)).astype(np.int64)
        near = (d > radius - reach) & (d <= radius + reach)
        return Node(-1, int(vantage), radius, grow(points[d <= radius]), grow(points[d > radius]), grow(points[near]))

    return grow(sample), leaves[0]


def route(node: Node, points: np.ndarray, rows: np.ndarray, mask: int, reach: int) -> Iterator[tuple[int, np.ndarray]]:
    """Leaves and the rows that belong to them."""
    if not len(rows):
        return
    if node.leaf >= 0:
        yield node.leaf, rows
        return
    d = np.bitwise_count((points[rows] ^ np.uint64(node.vantage)) & np.uint64(mask)).astype(np.int64)
    yield from route(node.inside, points, rows[d <= node.radius], mask, reach)
    yield from route(node.outside, points, rows[d > node.radius], mask, reach)
    yield from route(node.across, points, rows[(d > node.radius - reach) & (d <= node.radius + reach)], mask, reach)


def split_leaves(routed: DataFrame, reach: int) -> DataFrame:
    """``routed`` (``half``, ``leaf``, ``fp``) with a tree of its own in place of each leaf above ``LEAF``, level by level.

    A leaf's tree is grown in one task from a bounded sample of it, and its fingerprints go down that tree in many. So
    leaves stay small however many fingerprints there are; only those that no tree can part stay crowded.
    """
    most = LEAF

    def grown(frame: pd.DataFrame) -> pd.DataFrame:
        half, leaf, n, parts = (frame[c].iloc[0] for c in ("half", "leaf", "n", "parts"))
        sample = np.sort(frame["fp"].to_numpy())[:: max(1, len(frame) // LEAF_SAMPLE)].view(np.uint64)
        node, leaves = build_tree(sample, HALVES[half], reach, n / len(sample), most)
        return pd.DataFrame({"half": [half], "leaf": [leaf], "parts": [parts], "leaves": [leaves], "tree": [pickle.dumps(node)]})

    def sent(points: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        half, leaf, node = trees["tree_half"].iloc[0], trees["tree_leaf"].iloc[0], pickle.loads(trees["tree"].iloc[0])
        fp = points["fp"].to_numpy(dtype=np.int64)
        found = list(route(node, fp.view(np.uint64), np.arange(len(fp)), HALVES[half], reach))
        names = np.repeat([f"{leaf}/{sub}" for sub, _ in found], [len(at) for _, at in found])
        return pd.DataFrame({"half": half, "leaf": names, "fp": fp[np.concatenate([at for _, at in found])]}) if found else pd.DataFrame({"half": [], "leaf": [], "fp": []})

    kind, done = "half int, leaf string, fp long", None
    while True:
        sizes = routed.groupBy("half", "leaf").agg(F.count("*").alias("n")).where(F.col("n") > LEAF)
        sizes = settle(sizes.withColumn("parts", F.ceil(F.col("n") / PART).cast("int")), "leaf-sizes")
        if sizes.isEmpty():
            return routed if done is None else done.unionByName(routed)
        key = ["half", "leaf"]
        lot = F.pmod(F.xxhash64("fp", F.lit("leaf")), F.lit(1_000_003)) / F.lit(1_000_003.0)
        sample = routed.join(sizes, key).where(lot < F.lit(2.0 * LEAF_SAMPLE) / F.col("n"))
        trees = settle(sample.groupBy(*key).applyInPandas(grown, "half int, leaf string, parts int, leaves int, tree binary"), "leaf-trees")
        parted = trees.where("leaves > 1")
        part = F.pmod(F.xxhash64("fp", F.lit("part")), F.col("parts")).cast("int")
        crowded = routed.join(parted.select(*key, "parts"), key).select(*key, "fp", part.alias("part"))
        # columns of their own, as both sides come from one table
        spread = parted.select(*(F.col(c).alias(f"tree_{c}") for c in key), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("tree_part"), "tree")
        grouped = crowded.groupBy(*key, "part").cogroup(spread.groupBy("tree_half", "tree_leaf", "tree_part"))
        below = grouped.applyInPandas(sent, kind)
        settled = routed.join(parted.select(*key), key, "left_anti")
        done = settle(settled if done is None else done.unionByName(settled), "leaves")
        routed = settle(below, "leaves")


def links(distinct: DataFrame, bits: int = 2) -> DataFrame:
    """Links ``a``, ``b`` among distinct fingerprints (column ``fp``) that connect just those within ``bits`` of each other.

    A leaf gives each fingerprint at most one link, to the smallest one that it reaches there, so groups
    never turn into all their pairs. Leaves above ``LEAF`` get trees of their own; what stays crowded (fingerprints
    closer together than a tree can part) is split into blocks by hash, and each pair of blocks is searched on its own.
    """
    spark = distinct.sparkSession
    reach = bits // 2
    total = distinct.count()
    share = min(1.0, 2 * TREE_SAMPLE / max(1, total))
    lot = F.pmod(F.xxhash64("fp", F.lit("tree")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    rows = distinct.where(lot <= share).orderBy(F.xxhash64("fp")).limit(TREE_SAMPLE).collect()
    sample = np.array([r["fp"] for r in rows], dtype=np.int64).view(np.uint64)
    trees = [build_tree(sample, mask, reach, total / max(1, len(sample)), LEAF)[0] for mask in HALVES]

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            points = frame["fp"].to_numpy(dtype=np.int64)
            for half, (node, mask) in enumerate(zip(trees, HALVES, strict=True)):
                for leaf, at in route(node, points.view(np.uint64), np.arange(len(points)), mask, reach):
                    yield pd.DataFrame({"half": half, "leaf": str(leaf), "fp": points[at]})

    def searched(frame: pd.DataFrame) -> pd.DataFrame:
        points = np.unique(frame["fp"].to_numpy(dtype=np.int64))
        as_bits = points.view(np.uint64)
        near = np.empty((len(points), len(points)), dtype=bool)
        for at in range(0, len(points), 256):
            near[at : at + 256] = np.bitwise_count(as_bits[at : at + 256, None] ^ as_bits[None, :]) <= bits
        root = linked_within(near)
        other = np.flatnonzero(root != np.arange(len(points)))
        return pd.DataFrame({"a": points[other], "b": points[root[other]]})

    routed = split_leaves(settle(distinct.select("fp").mapInPandas(placed, "half int, leaf string, fp long"), "leaves"), reach)
    sizes = routed.groupBy("half", "leaf").agg(F.count("*").alias("n")).where(F.col("n") > LEAF)
    blocks = routed.join(sizes.withColumn("blocks", F.ceil(F.col("n") / (LEAF // 2)).cast("int")).drop("n"), ["half", "leaf"], "left")
    own = F.pmod(F.xxhash64("fp", F.lit("block")), F.coalesce("blocks", F.lit(1))).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    spread = blocks.select("half", "leaf", "fp", own.alias("own"), "blocks", every.alias("other"))
    # a block of a large leaf meets each other block, and with that itself
    spread = spread.where("blocks IS NULL OR own <> other OR blocks = 1")
    spread = spread.select("half", "leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    return spread.groupBy("half", "leaf", "i", "j").applyInPandas(searched, "a long, b long")


def _grouped(docs: DataFrame, bits: int, words: int) -> tuple[DataFrame, DataFrame]:
    """:func:`fingerprints` of ``docs``, and ``fp``, ``root`` (of its group) and ``component_id`` of each distinct one."""
    hashed = settle(fingerprints(docs, words), "fingerprints")
    distinct = settle(hashed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = settle(links(distinct, bits), "links")
    groups = components(found, "a", "b")
    rooted = settle(distinct.join(groups, distinct["fp"] == groups["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("root")), "rooted")
    least = settle(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    return hashed, settle(rooted.join(least, "root").select("fp", "root", "component_id"), "ids")


def near_duplicates(docs: DataFrame, bits: int = 2, words: int = 3) -> DataFrame:
    """Near-duplicate groups of all rows of ``docs`` (``doc_id``, ``text``; more columns are ignored).

    Returns ``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the smallest ``doc_id``
    that is reached over links of at most ``bits`` differing bits, itself included. One row per row: rows
    that repeat a ``doc_id`` count each, a null ``doc_id`` stays null but takes part in links, and a null text
    is an empty one. Only distinct fingerprints are compared, so copies meet in no join.
    """
    hashed, ids = _grouped(docs, bits, words)
    return hashed.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, bits: int = 2, words: int = 3, similarity: float | None = None) -> DataFrame:
    """One row of each near-duplicate group of ``docs``, with all its columns: the one with the smallest ``doc_id``.

    With a ``similarity``, groups are those of ``shingles.groups``, and ``bits`` is not used. Of rows that share the smallest
    ``doc_id`` of a group, the one with the smallest hash of its text stays, and of equal rows one. A null ``doc_id`` is
    larger than all others, and such rows are judged like any: of a group without an id one row stays.
    """
    if similarity is None:
        hashed, ids = _grouped(docs, bits, words)
        groups = hashed.join(ids, "fp").select("doc_id", "raw", "root")
    else:
        groups = shingles.groups(docs, words, similarity)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "raw")).alias("first")
    kept = groups.groupBy("root").agg(first).select("first.nameless", F.coalesce("first.doc_id", F.lit(0)).alias("id"), "first.raw")
    kept = settle(kept.select(F.col("nameless").alias("_nameless"), F.col("id").alias("_id"), F.col("raw").alias("_raw")), "kept")
    keys = {"_nameless": F.col("doc_id").isNull(), "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "_raw": F.xxhash64("text")}
    # rows meet and repeated ones go in one partitioning, so texts are shuffled once
    return docs.withColumns(keys).join(kept, list(keys), "left_semi").dropDuplicates(list(keys)).select(*docs.columns)
