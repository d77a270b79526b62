"""Near-duplicates by the Jaccard similarity of word shingles: candidates from MinHash bands, verified exactly.

A SimHash radius that is wide enough for a similarity of 0.8 takes about a quarter of the bits, and at such a
distance a vantage-point tree can prune nothing (README has figures). Bands of MinHash values find candidates instead:
two sets of similarity 0.8 share none of the ``BANDS`` bands with a chance below one in 100,000. Every candidate is
verified on its sets of shingles, so no link is a guess.

Texts that share a band value are a bucket. First every member meets the most central text of its bucket, which joins
nearly all near copies. What buckets still hold apart is then searched in blocks of texts: two blocks meet only if
they may hold a link between texts that are not joined yet. A row never carries more than one set of shingles, and no
pairs are written, only links that join something.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxwell.llm.common import components, linked_within, settle

SEED = 42
BANDS, ROWS = 30, 5
MULTIPLIERS = np.random.default_rng(SEED).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
MASKS = np.random.default_rng(SEED + 1).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
#: Texts of a block; two blocks are searched at once.
BLOCK = 512
#: Shingles in more texts than this are counted by a matrix product, others one by one.
OFTEN = 16
#: Odd multipliers that fold the values of a band into one number.
FOLD = np.random.default_rng(SEED + 2).integers(1, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as ``simhash.fingerprint`` takes them."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(parts: list[bytes], words: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; fewer words than a shingle are one, none have none."""
    if not parts:
        return np.empty(0, dtype=np.uint64)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), SEED)], dtype=np.uint64)
    digest, found = xxhash.xxh64_intdigest, []
    for at in range(0, len(parts) - words + 1, 8192):
        some = parts[at : at + 8192 + words - 1]
        grams = map(b" ".join, zip(*(some[i:] for i in range(words)), strict=False))
        found.append(np.unique(np.fromiter((digest(x, SEED) for x in grams), dtype=np.uint64)))
    return np.unique(np.concatenate(found))


def bands(hashes: np.ndarray) -> np.ndarray:
    """One number for each band of MinHash values of a set."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 512):
        mixed = (hashes[at : at + 512, None] ^ MASKS) * MULTIPLIERS
        np.minimum(least, mixed.min(axis=0), out=least)
    folded = ((least.reshape(BANDS, ROWS) >> np.uint64(7)) * FOLD).sum(axis=1, dtype=np.uint64)
    return (folded ^ (folded >> np.uint64(29))).view(np.int64)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``raw`` (hash of the text), ``key`` (hash of its words), ``size`` and ``bands`` of every row."""

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, sizes, found = [], [], []
            for text in frame["text"]:
                parts = words_of(text)
                own = shingles(parts, words)
                keys.append(xxhash.xxh64_intdigest(b" ".join(parts), SEED))
                sizes.append(len(own))
                found.append(bands(own))
            keys = np.array(keys, dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "raw": frame["raw"], "key": keys, "size": sizes, "bands": found})

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("raw"), "text")
    return rows.mapInPandas(hashed, "doc_id long, raw long, key long, size long, bands array<long>")


def sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``key`` and ``hashes`` of the ``wanted`` keys, each from its representative (``doc_id``, ``raw``)."""

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"key": frame["key"], "hashes": [shingles(words_of(t), words).view(np.int64) for t in frame["text"]]})

    rows = docs.select(F.col("doc_id").cast("long").alias("own"), F.xxhash64("text").alias("own_raw"), "text")
    met = rows.join(wanted, F.col("own").eqNullSafe(F.col("doc_id")) & (F.col("own_raw") == F.col("raw")))
    return met.select("key", "text").mapInPandas(hashed, "key long, hashes array<long>").dropDuplicates(["key"])


def star_blocks(stars: DataFrame, hashes: DataFrame) -> DataFrame:
    """Sets of the members of each star (``a`` the centre, ``b`` a member) in blocks, the centre's set in each of them."""
    sizes = stars.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b", F.lit("star")), F.col("parts")).cast("int")
    members = stars.join(sizes, "a").select("a", part.alias("part"), F.col("b").alias("key"))
    centres = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("key"))
    return members.unionByName(centres).join(hashes, "key").select("a", "part", "key", "hashes")


def linked_members(stars: DataFrame, hashes: DataFrame, similarity: float) -> DataFrame:
    """Those members ``b`` of each star that are similar enough to its centre ``a``."""

    def compared(frame: pd.DataFrame) -> pd.DataFrame:
        centre = frame["a"].iloc[0]
        rows = dict(zip(frame["key"], frame["hashes"], strict=True))
        own = np.asarray(rows.pop(centre))
        found = []
        for key, other in rows.items():
            both = int(np.isin(other, own, assume_unique=True).sum())
            if both >= similarity * (len(own) + len(other) - both):
                found.append(key)
        return pd.DataFrame({"a": np.full(len(found), centre, dtype=np.int64), "b": np.array(found, dtype=np.int64)})

    return star_blocks(stars, hashes).groupBy("a", "part").applyInPandas(compared, "a long, b long")


def shared(sets_of: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of some sets have in common."""
    m = len(sets_of)
    owner = np.repeat(np.arange(m), [len(x) for x in sets_of])
    every = np.concatenate(sets_of) if m else np.empty(0, np.int64)
    order = np.lexsort((owner, every))
    every, owner = every[order], owner[order]
    new = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, np.int64)
    times = np.diff(np.concatenate([new, [len(every)]])).astype(np.int64)
    kind = np.repeat(np.arange(len(new)), times)
    often = times > OFTEN
    both = np.zeros((m, m), dtype=np.float32)
    columns = np.cumsum(often) - 1
    frequent = often[kind]
    column, row = columns[kind[frequent]], owner[frequent]
    for low in range(0, int(often.sum()), 4096):
        some = (column >= low) & (column < low + 4096)
        has = np.zeros((m, 4096), dtype=np.float32)
        has[row[some], column[some] - low] = 1
        both += has @ has.T
    kind, owner = kind[~frequent], owner[~frequent]
    for gap in range(1, OFTEN):
        same = np.flatnonzero(kind[gap:] == kind[:-gap])
        if not len(same):
            break
        np.add.at(both, (owner[same], owner[same + gap]), 1)
        np.add.at(both, (owner[same + gap], owner[same]), 1)
    np.fill_diagonal(both, [len(x) for x in sets_of])
    return both


def joined_in_blocks(members: DataFrame, hashes: DataFrame, similarity: float) -> DataFrame:
    """Links ``a``, ``b`` between roots that join texts of one family, found block by block.

    ``members`` has ``family``, ``root``, ``key`` and ``size``. Texts are sorted by family, root and size and cut into blocks
    in that order. Two blocks of a family meet unless all their texts have one root, or sizes that rule a link out.
    """
    placed = members.repartitionByRange("family", "root", "size", "key").sortWithinPartitions("family", "root", "size", "key")
    at = F.monotonically_increasing_id()
    blocks = settle(placed.withColumn("block", F.floor(at / BLOCK)), "blocks")
    stats = [F.min("root").alias("root0"), F.max("root").alias("root1"), F.min("size").alias("size0"), F.max("size").alias("size1")]
    table = settle(blocks.groupBy("family", "block").agg(*stats), "table")
    left = table.select(F.col("family"), *(F.col(c).alias(f"{c}_i") for c in ("block", "root0", "root1", "size0", "size1")))
    right = table.select(F.col("family"), *(F.col(c).alias(f"{c}_j") for c in ("block", "root0", "root1", "size0", "size1")))
    one_root = (F.col("root0_i") == F.col("root1_i")) & (F.col("root0_i") == F.col("root0_j")) & (F.col("root0_j") == F.col("root1_j"))
    fit = (F.col("size1_i") >= F.lit(similarity) * F.col("size0_j")) & (F.col("size1_j") >= F.lit(similarity) * F.col("size0_i"))
    pairs = left.join(right, "family").where((F.col("block_i") <= F.col("block_j")) & ~one_root & fit)
    pairs = settle(pairs.select("family", "block_i", "block_j"), "pairs")
    ends = F.explode(F.array_distinct(F.array("block_i", "block_j"))).alias("block")
    sent = pairs.select("family", "block_i", "block_j", ends).join(blocks, ["family", "block"])
    sent = sent.select("family", "block_i", "block_j", "key", "root").join(hashes, "key")

    def compared(frame: pd.DataFrame) -> pd.DataFrame:
        sets_of = [np.asarray(x) for x in frame["hashes"]]
        sizes = np.array([len(x) for x in sets_of], dtype=np.float32)
        both = shared(sets_of)
        near = both >= similarity * (sizes[:, None] + sizes[None, :] - both)
        roots, root = np.unique(frame["root"].to_numpy(), return_inverse=True)
        x, y = np.nonzero(near)
        adjacent = np.zeros((len(roots), len(roots)), dtype=bool)
        adjacent[root[x], root[y]] = True
        least = linked_within(adjacent)
        other = np.flatnonzero(least != np.arange(len(roots)))
        return pd.DataFrame({"a": roots[least[other]], "b": roots[other]})

    return sent.select("family", "block_i", "block_j", "key", "root", "hashes").groupBy("family", "block_i", "block_j").applyInPandas(compared, "a long, b long")


def groups(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``doc_id``, ``raw`` and ``root`` of every row: rows of one root are joined by links of at least ``similarity``.

    Equal words are one key, whatever their case and spaces. The most central member of a bucket is the one whose
    buckets hold most texts together. Buckets with several roots after that join their roots into families, and the
    members of such buckets are searched block by block within their family, so every pair that shares a band value is
    verified unless it is joined already.
    """
    rows = settle(signatures(docs, words), "signatures")
    one = F.min(F.struct("doc_id", "raw")).alias("first")
    distinct = settle(rows.groupBy("key").agg(one, F.first("size").alias("size"), F.first("bands").alias("bands")), "keys")
    each = distinct.where("size > 0").select("key", "size", F.posexplode("bands").alias("band", "value"))
    common = each.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    buckets = settle(each.join(common, ["band", "value"]), "buckets")
    central = settle(buckets.groupBy("key").agg(F.sum("n").alias("weight"), F.first("size").alias("size")), "central")
    wanted = central.select("key").join(distinct, "key").select("key", "first.doc_id", "first.raw")
    hashes = settle(sets(docs, wanted, words), "sets")
    weighed = buckets.drop("n", "size").join(central, "key")
    best = weighed.groupBy("band", "value").agg(F.max(F.struct("weight", "key", "size")).alias("best"))
    centres = best.select("band", "value", F.col("best.key").alias("a"), F.col("best.size").alias("a_size"))
    near = lambda x, y: F.least(x, y) >= F.lit(similarity) * F.greatest(x, y)
    stars = buckets.join(centres, ["band", "value"]).where((F.col("key") != F.col("a")) & near("size", "a_size"))
    stars = settle(stars.select("a", F.col("key").alias("b")).distinct(), "stars")
    found = settle(linked_members(stars, hashes, similarity), "linked")
    linked = settle(components(found, "a", "b"), "joined")
    members = buckets.join(linked, buckets["key"] == linked["node"], "left").select("band", "value", "key", "size", F.coalesce("component", "key").alias("root"))
    members = settle(members, "members")
    open_buckets = members.groupBy("band", "value").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most")
    left = settle(members.join(open_buckets.drop("most"), ["band", "value"]).select("key", "size", "root", "least").distinct(), "left")
    kin = settle(components(left.select("least", "root").distinct(), "least", "root"), "kin")
    family = left.select("key", "size", "root").distinct().join(kin, F.col("root") == F.col("node")).select(F.col("component").alias("family"), "root", "key", "size")
    rest = settle(joined_in_blocks(family, hashes, similarity), "rest")
    joined = components(found.unionByName(rest), "a", "b")
    return rows.join(joined, rows["key"] == joined["node"], "left").select("doc_id", "raw", F.coalesce("component", "key").alias("root"))
