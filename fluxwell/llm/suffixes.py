"""Exact removal of long repeats with a logarithmic family of sparse suffix arrays.

Only suffixes at sampled places are kept: of each window of ``LENGTH`` bytes the place, among its first ``SAMPLED``,
whose next eight bytes hash lowest. Equal windows sample equal places, so two equal windows always have a pair of
sampled suffixes that share their first ``PREFIX`` bytes. A level is an array of such suffixes in the order of a
fingerprint of that prefix, which keeps equal prefixes together as any order of suffixes does. A new batch gets its
own array, is merge-scanned against every level, and becomes a level; two levels of one size merge into the next.

A suffix stands for a run: all neighbouring windows that sample it. Runs that share the prefix are told apart in
three steps, each on fewer rows: whole runs by a fingerprint of all their bytes, then blocks of ``BLOCK`` windows,
then single windows. A block is settled at once if all its bytes, or none of what its windows have in common, occur
again. Groups are only ever counted, so a passage that is in a third of all documents is no task's burden.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxwell.llm.common import discard, settle

#: Bytes of a repeat that counts.
LENGTH = 400
#: Places of a window that may be sampled; a suffix shares at least the rest of the window.
SAMPLED = 128
PREFIX = LENGTH - SAMPLED + 1
#: Windows of a run that are settled together at the second step.
BLOCK = 16
#: Bytes that a task hashes at once; longer texts are cut into overlapping stretches.
STRETCH = 1 << 20
#: Batches in which a table that is there at once enters the index.
BATCHES = 3

U64 = np.uint64
MIX, MIX2 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9)
#: Odd bases of two polynomials modulo 2^64, which fingerprint stretches of bytes.
BASES = [int(x) | 1 for x in np.random.default_rng(42).integers(1 << 40, 1 << 62, 2)]
#: Powers of the bases and of their inverses, as far as some text has needed them.
POWERS: list[tuple[np.ndarray, np.ndarray]] = []

MARKS = "row long, doc_id long, hash long, n_bytes long, lo array<int>, shape array<int>, sig array<long>, ctx array<long>"
RECORDS = "sig long, ctx long, block int, core long, outer long"
WINDOWS = "core long, outer long, bit int, w1 long, w2 long"


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> U64(32))) * MIX
    return (values ^ (values >> U64(29))) * MIX2


def powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    if not POWERS or len(POWERS[0][0]) < n:
        size = max(n, STRETCH + 2 * LENGTH)
        up = [np.multiply.accumulate(np.concatenate([np.ones(1, U64), np.full(size - 1, b, U64)])) for b in BASES]
        down = [np.multiply.accumulate(np.concatenate([np.ones(1, U64), np.full(size - 1, pow(b, -1, 1 << 64), U64)])) for b in BASES]
        POWERS[:] = list(zip(up, down, strict=True))
    return POWERS


class Stretches:
    """Fingerprints of any stretches of some bytes, from prefix sums of the two polynomials."""

    def __init__(self, flat: np.ndarray):
        wide = flat.astype(U64) + U64(1)
        self.sums, self.down = [], []
        for up, down in powers(len(flat) + 1):
            sums = np.zeros(len(flat) + 1, U64)
            np.cumsum(wide * up[: len(flat)], out=sums[1:])
            self.sums.append(sums)
            self.down.append(down)

    def of(self, which: int, start: np.ndarray, end: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        """Fingerprints of ``[start, end)``, as signed numbers; ``salt`` tells apart what may not meet."""
        sums = self.sums[which]
        found = (sums[end] - sums[start]) * self.down[which][start]
        return mix(found + np.asarray(salt).astype(U64) * MIX2).view(np.int64)


def sampled(flat: np.ndarray) -> np.ndarray:
    """For each window of ``flat`` its sampled place, of equal hashes the first."""
    n = len(flat)
    key = np.zeros(n, U64)
    for i in range(8):
        key[: n - 7] |= flat[i : n - 7 + i].astype(U64) << U64(8 * i)
    key = (mix(key) & U64(0xFFFFFFFF00000000)) | np.arange(n, dtype=U64)
    rows = -(-n // SAMPLED) + 1
    padded = np.full(rows * SAMPLED, np.iinfo(U64).max, U64)
    padded[:n] = key
    padded = padded.reshape(rows, SAMPLED)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - LENGTH + 1
    least = np.minimum(behind[:windows], ahead[SAMPLED - 1 : SAMPLED - 1 + windows])
    return (least & U64(0xFFFFFFFF)).astype(np.int64)


def runs(texts: list[bytes], stretch: int = STRETCH) -> tuple[np.ndarray, ...]:
    """Runs of the windows of ``texts``, in order: text, first window, windows before and including the sampled place
    (``back``), count of windows, fingerprints of the suffix's prefix and of all bytes of the run."""
    parts, owner, at = [], [], []
    for i, text in enumerate(texts):
        for start in range(0, max(0, len(text) - LENGTH + 1), stretch):
            parts.append(text[start : start + stretch + LENGTH - 1])
            owner.append(i)
            at.append(start)
    found: list[tuple[np.ndarray, ...]] = []
    low = 0
    while low < len(parts):
        high, size = low + 1, len(parts[low])
        while high < len(parts) and size + len(parts[high]) <= stretch:
            size += len(parts[high])
            high += 1
        sizes = np.array([len(x) for x in parts[low:high]])
        flat = np.frombuffer(b"".join(parts[low:high]), np.uint8)
        starts = np.cumsum(sizes) - sizes
        # windows that lie in one part
        counts = sizes - LENGTH + 1
        part = np.repeat(np.arange(len(sizes)), counts)
        window = np.arange(len(part)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[part]
        place = sampled(flat)[window]
        new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (part[1:] != part[:-1])]))
        count = np.diff(np.concatenate([new, [len(part)]]))
        first, place, part = window[new], place[new], part[new]
        stretches, back = Stretches(flat), place - first
        sig = stretches.of(0, place, place + PREFIX)
        ctx = stretches.of(1, first, first + count - 1 + LENGTH, back * 1024 + count)
        text = np.array(owner[low:high])[part]
        found.append((text, first - starts[part] + np.array(at[low:high])[part], back, count, sig, ctx))
        low = high
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def marks(docs: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """One row per row of ``docs`` with its runs: ``lo`` (first window) and ``shape`` (``back * 1024 + count``)."""

    def marked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [x or b"" for x in frame["text"]]
            text, lo, back, count, sig, ctx = runs(texts, stretch)
            cut = np.searchsorted(text, np.arange(1, len(texts)))
            split = lambda x: [a.tolist() for a in np.split(x, cut)]
            columns = {"lo": split(lo), "shape": split(back * 1024 + count), "sig": split(sig), "ctx": split(ctx)}
            yield pd.DataFrame({"row": frame["row"], "doc_id": frame["doc_id"].astype("Int64"), "hash": frame["hash"], "n_bytes": [len(x) for x in texts], **columns})

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.xxhash64("text").alias("hash"), F.col("text").cast("binary").alias("text"))
    return settle(rows.mapInPandas(marked, MARKS), "marks")


def entries(marked: DataFrame) -> DataFrame:
    """One row per run: ``row``, ``lo``, ``shape``, ``sig``, ``ctx``."""
    return marked.where(F.size("lo") > 0).select("row", F.inline(F.arrays_zip("lo", "shape", "sig", "ctx")))


class SuffixIndex:
    """Levels of suffix arrays: level ``k`` holds the runs of ``2 ** k`` batches, equal runs once with their count.

    ``matched`` has the fingerprints of prefixes that some merge-scan found twice. A level that was merged is deleted.
    Every level is a written table, so a lost executor costs a read.
    """

    def __init__(self) -> None:
        self.levels: dict[int, DataFrame] = {}
        self.matched: list[DataFrame] = []

    def add(self, batch: DataFrame) -> None:
        """Index the runs of new documents (columns of :func:`entries`)."""
        fresh = self._merged(batch.withColumn("n", F.lit(1).cast("long")).withColumn("one", F.struct("row", "lo", "shape")))
        fresh = settle(fresh, "suffixes")
        own = fresh.groupBy("sig").agg(F.sum("n").alias("n")).where("n > 1").select("sig")
        prefixes = fresh.select("sig").distinct()
        for level in self.levels.values():
            own = own.union(prefixes.hint("merge").join(level.select("sig").distinct(), "sig"))
        self.matched.append(settle(own.distinct(), "matched"))
        size = 0
        while size in self.levels:
            parts = fresh, self.levels.pop(size)
            fresh = settle(self._merged(parts[0].unionByName(parts[1])), "suffixes")
            discard(*parts)
            size += 1
        self.levels[size] = fresh

    @staticmethod
    def _merged(suffixes: DataFrame) -> DataFrame:
        one = suffixes.groupBy("sig", "ctx").agg(F.sum("n").alias("n"), F.min("one").alias("one"))
        return one.sortWithinPartitions("sig", "ctx")

    def repeated(self) -> DataFrame:
        """Runs of all levels whose prefix was matched: ``sig``, ``ctx``, ``n`` (times the run occurs), ``one`` of them."""
        matched = self.matched[0]
        for more in self.matched[1:]:
            matched = matched.union(more)
        matched = settle(matched.distinct(), "matched")
        found = [level.join(matched, "sig", "left_semi") for level in self.levels.values()]
        every = found[0]
        for more in found[1:]:
            every = every.unionByName(more)
        every = settle(every.groupBy("sig", "ctx").agg(F.sum("n").alias("n"), F.min("one").alias("one")), "repeated")
        discard(matched)
        return every

    def discard(self) -> None:
        """Delete all levels."""
        discard(*self.levels.values(), *self.matched)
        self.levels, self.matched = {}, []


def _packed(texts: list[bytes], most: int = STRETCH) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of at most ``most`` bytes together."""
    low, size = 0, 0
    for i, text in enumerate(texts):
        if i > low and size + len(text) > most:
            yield low, i
            low, size = i, 0
        size += len(text)
    if low < len(texts):
        yield low, len(texts)


def contexts(docs: DataFrame, marked: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the ``wanted`` runs (``sig``, ``ctx``, ``one``): ``sig``, ``ctx``, ``shape``, ``bytes``."""
    per_row = wanted.groupBy("one.row").agg(F.collect_list(F.struct("one.lo", "one.shape", "sig", "ctx")).alias("runs"))
    named = marked.select("row", F.col("doc_id").alias("own_id"), F.col("hash").alias("own_hash")).join(per_row, "row")
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("hash"), F.col("text").cast("binary").alias("text"))
    met = named.join(texts, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("hash") == F.col("own_hash")))
    each = met.select("text", F.explode("runs").alias("run"))
    size = F.col("run.shape").bitwiseAND(1023) - 1 + LENGTH
    return settle(each.select("run.sig", "run.ctx", "run.shape", F.expr("substring(text, run.lo + 1, (run.shape & 1023) - 1 + %d)" % LENGTH).alias("bytes")).where(F.length("bytes") == size), "contexts")


def records(found: DataFrame) -> DataFrame:
    """Blocks of the runs in ``found`` (:func:`contexts`): fingerprints of what all windows share, and of all bytes.

    A block takes the windows whose sampled place lies ``BLOCK * block`` to ``BLOCK * (block + 1) - 1`` bytes after
    their start, as far as the run has them.
    """

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["bytes"].tolist()
            for low, high in _packed(texts):
                part = frame.iloc[low:high]
                sizes = np.array([len(x) for x in texts[low:high]])
                start = np.cumsum(sizes) - sizes
                stretches = Stretches(np.frombuffer(b"".join(texts[low:high]), np.uint8))
                shape = part["shape"].to_numpy().astype(np.int64)
                back, count = shape >> 10, shape & 1023
                least, most = (back - count + 1) // BLOCK, back // BLOCK
                own = np.repeat(np.arange(len(part)), most - least + 1)
                block = np.arange(len(own)) - np.repeat(np.cumsum(most - least + 1) - (most - least + 1), most - least + 1) + least[own]
                place = (start + back)[own]
                core = stretches.of(0, place - BLOCK * block, place - BLOCK * block - BLOCK + 1 + LENGTH, block)
                far, near = np.minimum(BLOCK * block + BLOCK - 1, back[own]), np.maximum(BLOCK * block, (back - count + 1)[own])
                outer = stretches.of(1, place - far, place - near + LENGTH, far * 1024 + near)
                yield pd.DataFrame({"sig": part["sig"].to_numpy()[own], "ctx": part["ctx"].to_numpy()[own], "block": block, "core": core, "outer": outer})

    return settle(found.mapInPandas(hashed, RECORDS), "records")


def windows(found: DataFrame) -> DataFrame:
    """Single windows of blocks (``found``: ``shape``, ``bytes``, ``block``, ``core``, ``outer``) with their fingerprints."""

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["bytes"].tolist()
            for low, high in _packed(texts):
                part = frame.iloc[low:high]
                sizes = np.array([len(x) for x in texts[low:high]])
                start = np.cumsum(sizes) - sizes
                stretches = Stretches(np.frombuffer(b"".join(texts[low:high]), np.uint8))
                shape, block = (part[c].to_numpy().astype(np.int64) for c in ("shape", "block"))
                back, count = shape >> 10, shape & 1023
                own = np.repeat(np.arange(len(part)), BLOCK)
                bit = np.tile(np.arange(BLOCK), len(part))
                before = BLOCK * block[own] + bit
                has = (before <= back[own]) & (before > (back - count)[own])
                own, bit, before = own[has], bit[has], before[has]
                first = (start + back)[own] - before
                yield pd.DataFrame(
                    {"core": part["core"].to_numpy()[own], "outer": part["outer"].to_numpy()[own], "bit": bit}
                    | {f"w{i + 1}": stretches.of(i, first, first + LENGTH, before) for i in (0, 1)}
                )

    return settle(found.mapInPandas(hashed, WINDOWS), "windows")


def verdicts(docs: DataFrame, marked: DataFrame, repeated: DataFrame) -> DataFrame:
    """Repeated windows of the ``repeated`` runs: ``sig``, ``ctx``, ``every`` (all are) and ``blocks`` (``block``, ``mask``)."""
    pair = F.struct("sig", "ctx")
    several = repeated.groupBy("sig").agg(F.count("*").alias("k")).where("k > 1").select("sig")
    text_of = contexts(docs, marked, repeated.join(several, "sig", "left_semi"))
    found = records(text_of)
    # the smallest and the largest run differ just where there are several, however often a run was read
    outers = settle(found.groupBy("core", "outer").agg(F.min(pair).alias("one"), F.max(pair).alias("last"), F.first("block").alias("block")), "outers")
    open_cores = outers.groupBy("core").agg(F.count("*").alias("k")).where("k > 1").select("core")
    reps = outers.join(open_cores, "core", "left_semi").select("core", "outer", "block", "one.sig", "one.ctx")
    single = windows(reps.join(text_of.dropDuplicates(["sig", "ctx"]), ["sig", "ctx"]).select("shape", "bytes", "block", "core", "outer"))
    blocks = F.struct("core", "outer")
    again = single.groupBy("w1", "w2").agg(F.min(blocks).alias("a"), F.max(blocks).alias("z")).where("a <> z").select("w1", "w2")
    masks = single.join(again, ["w1", "w2"]).groupBy("core", "outer").agg(F.bit_or(F.expr("shiftleft(1, bit)")).alias("mask"))
    all_bits = (1 << BLOCK) - 1
    judged = outers.join(masks, ["core", "outer"], "left").select("core", "outer", F.when(F.col("one") != F.col("last"), all_bits).otherwise(F.col("mask")).alias("mask"))
    judged = settle(judged.where("mask IS NOT NULL"), "judged")
    partly = found.join(judged, ["core", "outer"]).groupBy("sig", "ctx").agg(F.collect_set(F.struct("block", "mask")).alias("blocks"))
    every = repeated.select("sig", "ctx", (F.col("n") > 1).alias("every"))
    decided = settle(every.join(partly, ["sig", "ctx"], "left").where("every OR blocks IS NOT NULL"), "verdicts")
    discard(text_of, found, outers, single, judged)
    return decided


def spans_of(marked: DataFrame, judged: DataFrame) -> DataFrame:
    """``row`` and ``spans`` (``start``, ``end`` in bytes, maximal, in order) of rows that have any."""
    met = entries(marked).join(judged, ["sig", "ctx"]).select("row", "lo", "shape", "every", "blocks")
    back, count = F.expr("shape >> 10"), F.expr("shape & 1023")
    # the windows of a run that are repeated, as the number of bytes from their start to the sampled place
    bits = F.expr(f"flatten(transform(coalesce(blocks, array()), b -> transform(filter(sequence(0, {BLOCK - 1}), i -> (shiftright(b.mask, i) & 1) = 1), i -> {BLOCK} * b.block + i)))")
    starts = F.transform(bits, lambda before: F.col("lo") + back - before)
    own = F.filter(starts, lambda start: (start >= F.col("lo")) & (start < F.col("lo") + count))
    whole = F.array(F.struct(F.col("lo").alias("start"), (F.col("lo") + count).alias("end")))
    single = F.transform(own, lambda start: F.struct(start.alias("start"), (start + 1).alias("end")))
    parts = F.when(F.col("every"), whole).otherwise(single)
    gathered = met.select("row", F.explode(parts).alias("part")).groupBy("row").agg(F.sort_array(F.collect_list("part")).alias("parts"))

    def merged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for parts in frame["parts"]:
                start = np.array([p["start"] for p in parts], dtype=np.int64)
                end = np.array([p["end"] for p in parts], dtype=np.int64) - 1 + LENGTH
                new = np.concatenate([[True], start[1:] > np.maximum.accumulate(end)[:-1]])
                at = np.flatnonzero(new)
                out.append([{"start": int(s), "end": int(e)} for s, e in zip(start[at], np.maximum.reduceat(end, at), strict=True)])
            yield pd.DataFrame({"row": frame["row"], "spans": out})

    return gathered.mapInPandas(merged, "row long, spans array<struct<start:bigint,end:bigint>>")


def remove_repeats(docs: DataFrame, batches: int = BATCHES, stretch: int = STRETCH) -> DataFrame:
    """Cut every byte that lies in a ``LENGTH``-byte string which also starts anywhere else in ``docs``.

    Takes ``doc_id`` and ``text`` (more columns are ignored) and returns one row per row: ``doc_id``, ``n_bytes`` (of the
    UTF-8 text), ``spans`` (removed, maximal, ``start`` and ``end`` in bytes) and ``kept`` (what remains, as binary).
    Overlapping occurrences count, the same text included; strings are judged on the input. Null and empty texts have
    no bytes; repeated rows count each; null ids stay null. ``batches`` only says in how many steps the index grows, ``stretch`` how many bytes a task hashes at once.
    """
    marked = marks(docs, stretch)
    index = SuffixIndex()
    for k in range(batches):
        index.add(entries(marked.where(F.pmod(F.xxhash64("row"), F.lit(batches)) == k)))
    repeated = index.repeated()
    index.discard()
    judged = verdicts(docs, marked, repeated)
    spans = spans_of(marked, judged)
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    # a text's spans are the same wherever the text stands
    named = marked.join(spans, "row").select(F.col("doc_id").alias("own_id"), F.col("hash").alias("own_hash"), "spans").dropDuplicates(["own_id", "own_hash"])
    named = settle(named, "spans")
    discard(marked, repeated, judged)
    text = F.coalesce(docs["text"].cast("binary"), F.lit(b""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("hash"), text.alias("bytes"))
    met = rows.join(named, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("hash") == F.col("own_hash")), "left")
    # strings only carry the bytes here; joining them neither reads nor changes what they hold
    ends = F.concat(F.array(F.lit(0).cast("long")), F.col("spans.end"))
    starts = F.concat(F.col("spans.start"), F.array(F.length("bytes").cast("long")))
    kept = F.expr("array_join(transform(arrays_zip(ends, starts), x -> cast(substring(bytes, cast(x.ends AS int) + 1, cast(x.starts - x.ends AS int)) AS string)), '')")
    cut = F.when(F.col("spans").isNull(), F.col("bytes")).otherwise(kept.cast("binary"))
    cuts = met.select("doc_id", "bytes", "spans", ends.alias("ends"), starts.alias("starts"))
    return cuts.select("doc_id", F.length("bytes").cast("long").alias("n_bytes"), F.coalesce("spans", none).alias("spans"), cut.alias("kept"))
