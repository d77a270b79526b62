"""Near-duplicate vectors by an exact metric range join over pivots.

Vectors of one label are cut into cells, each around its nearest pivot. Cosine ``c`` between unit vectors is
the distance ``sqrt(2 - 2 c)``, so the triangle inequality tells which other cells can hold a neighbour: a
vector goes to cell ``j`` only if it is at most twice the search distance farther from pivot ``j`` than from
its own. Cells that are still crowded get pivots of their own, level by level. The cells are then joined
independently.
"""

from __future__ import annotations

from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxwell.llm.common import components, linked_within, settle

THRESHOLD = 0.93
#: Vectors, guests included, that a cell may hold before it gets pivots of its own.
CELL = 2048
#: Pivots that one cell may get, and vectors of it that they are drawn from and tried on.
MOST_PIVOTS = 256
SAMPLE = 2048
#: Vectors of one cell that a task places.
PART = 8192
#: A cell gets as many pivots as leave the fewest pairs and make at most so many copies of its vectors.
MOST_COPIES = 4
#: A cell of a cell is cut only where that leaves at most this share of its pairs (half of them go even if nothing is pruned).
PAIRS_LEFT = 0.35
#: Vectors in one block of a crowded cell that further pivots can't cut; such cells are joined block by block.
BLOCK = 2048
#: Room for rounding in the bound; a pair itself is judged by its cosine alone.
SLACK = 1e-6


def usable(vector: str) -> F.Column:
    """Whether a vector has only finite components, and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Near-duplicate groups of all rows of ``rows`` (``vec_id``, ``embedding``, ``label``; more columns are ignored).

    Vectors are linked where their labels are equal and their cosine, in double precision, is at least
    ``threshold``. Returns for each row ``vec_id``, ``n_links`` (other rows linked directly), ``component_id``
    (smallest ``vec_id`` reachable) and ``kept`` (whether that is its own). Vectors that are null, zero or not
    finite, and rows without a label, link with nothing; vectors of different sizes neither. Rows that repeat
    a ``vec_id`` count each; a null ``vec_id`` stays null. Equal vectors of a label are compared once.
    """
    rows = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), F.col("label"))
    good = rows.where(usable("embedding") & F.col("label").isNotNull())
    distinct = good.groupBy("label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    distinct = settle(distinct.select(F.monotonically_increasing_id().alias("id"), "*"), "vectors")
    found = settle(join(distinct, threshold), "joined")
    counted = settle(found.groupBy("id").agg(F.sum("n").alias("n")), "counts")
    groups = components(found.where("root <> id"), "id", "root")
    rooted = distinct.select("id", "label", "embedding", "copies", "least").join(counted, "id", "left").join(groups, distinct["id"] == groups["node"], "left")
    rooted = settle(rooted.select("label", "embedding", "least", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("root")), "rooted")
    least = settle(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    ids = settle(rooted.join(least, "root").select("label", "embedding", "n_links", "component_id"), "ids")
    linked = good.join(ids, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~(usable("embedding") & F.col("label").isNotNull())).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def cut_cells(rows: DataFrame, reach: float) -> DataFrame:
    """``rows`` (``label``, ``dims``, ``id``, ``copies``, ``embedding``) in cells, with ``cell``, ``levels`` and ``homes``.

    Bit ``k`` of ``homes`` says that a row is at home in its cell of level ``k``, not a guest there; ``levels`` has a
    bit for each level that the cell went through. A vector is a guest in later cells only, so each pair within
    ``reach`` is together in just one cell, with one of the two at home, at each level. Pivots are chosen
    in one task from a bounded sample of a cell, and its vectors are placed in many. A label above ``CELL`` is cut once at
    least; its cells are cut on while that pays.
    """
    label = rows.schema["label"].dataType.simpleString()
    most, pairs_left, most_copies, sample_size = MOST_PIVOTS, PAIRS_LEFT, MOST_COPIES, SAMPLE
    width, part_size = CELL, PART

    def chosen(frame: pd.DataFrame) -> pd.DataFrame:
        n, first = int(frame["n"].iloc[0]), not frame["levels"].iloc[0]
        order = np.argsort(frame["lot"].to_numpy(), kind="stable")
        unit = _unit(np.stack(frame["embedding"].to_numpy()[order]))
        scale, best = n / len(unit), None
        size = min(most, len(unit) // 2, 4 * -(-n // width))
        while size >= 2:
            far = _far(unit, unit[:size])
            guests, cell = _guests(far, reach)
            home = np.bincount(cell, minlength=size)
            held = guests.sum(axis=0) + home
            # cells below the least width cost as much as one of it
            pairs = (home * np.maximum(held, width / 4 / scale)).sum() / len(unit) ** 2
            pays = first or (pairs <= pairs_left and held.max() <= 0.75 * len(unit))
            if pays and held.sum() <= most_copies * len(unit) and (best is None or pairs < best[0]):
                best = (pairs, size)
            size //= 2
        pivots = unit[: best[1]].ravel() if best else np.zeros(0)
        return frame.iloc[:1][["label", "dims", "cell", "parts"]].assign(pivots=[pivots])

    def placed(points: pd.DataFrame, cut: pd.DataFrame) -> pd.DataFrame:
        columns = ["label", "dims", "cell", "levels", "homes", "id", "copies", "embedding"]
        if not len(points):
            return pd.DataFrame({c: [] for c in columns})
        points = points.reset_index(drop=True)
        unit = _unit(np.stack(points["embedding"].to_numpy()))
        far = _far(unit, np.asarray(cut["pivots"].iloc[0]).reshape(-1, unit.shape[1]))
        guests, cell = _guests(far, reach)
        at, others = np.nonzero(guests)
        at = np.concatenate([np.arange(len(points)), at])
        out = points.iloc[at].reset_index(drop=True)
        level = out["levels"].to_numpy() + 1
        out["homes"] = out["homes"].to_numpy() + np.where(np.arange(len(at)) < len(points), level, 0)
        out["levels"] = out["levels"].to_numpy() + level
        out["cell"] = out["cell"].to_numpy() + "/" + np.concatenate([cell, others]).astype(str).astype(object)
        return out[columns]

    key, done = ["label", "dims", "cell"], None
    kind = f"label {label}, dims int, cell string, levels long, homes long, id long, copies long, embedding array<double>"
    cells = rows.select("label", "dims", F.lit("").alias("cell"), F.lit(0).cast("long").alias("levels"), F.lit(0).cast("long").alias("homes"), "id", "copies", "embedding")
    for _ in range(60):  # bits of a long; what would be crowded even then is joined block by block
        sizes = cells.groupBy(*key).agg(F.count("*").alias("n")).where((F.col("n") > width) & (F.col("dims") > 0))
        sizes = settle(sizes.withColumn("parts", F.ceil(F.col("n") / part_size).cast("int")), "cell-sizes")
        if sizes.isEmpty():
            break
        lot = F.pmod(F.xxhash64("embedding", F.lit("pivot")), F.lit(1_000_003)) / F.lit(1_000_003.0)
        sample = cells.join(sizes, key).withColumn("lot", lot).where(F.col("lot") < F.lit(float(sample_size)) / F.col("n"))
        pivots = settle(sample.groupBy(*key).applyInPandas(chosen, f"label {label}, dims int, cell string, parts int, pivots array<double>"), "pivots")
        pivots = pivots.where(F.size("pivots") > 0)
        if pivots.isEmpty():
            break
        part = F.pmod(F.xxhash64("id", F.lit("part")), F.col("parts")).cast("int")
        crowded = cells.join(pivots.select(*key, "parts"), key).withColumn("part", part).drop("parts")
        # columns of their own, as both sides come from one table
        spread = pivots.select(*(F.col(c).alias(f"cut_{c}") for c in key), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("cut_part"), "pivots")
        below = crowded.groupBy(*key, "part").cogroup(spread.groupBy("cut_label", "cut_dims", "cut_cell", "cut_part")).applyInPandas(placed, kind)
        settled = cells.join(pivots.select(*key), key, "left_anti").select(*cells.columns)
        done = settled if done is None else done.unionByName(settled)
        cells = settle(below, "cells")
    return cells if done is None else done.unionByName(cells)


def join(distinct: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per block of the join and vector: ``id``, ``n`` (rows linked there), ``root`` (smallest ``id`` reached there).

    ``distinct`` has ``id``, ``label``, ``embedding``, ``copies``. Each pair of vectors meets in one block.
    """
    reach = sqrt(max(0.0, 2 - 2 * threshold)) + SLACK

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        i, j, levels = (int(frame[c].iloc[0]) for c in ("i", "j", "levels"))
        frame = frame.iloc[np.argsort(frame["homes"].to_numpy() == 0, kind="stable")]
        homes, own, copies = (frame[c].to_numpy() for c in ("homes", "own", "copies"))
        # guests of every level meet only those that are at home somewhere
        m, h = len(frame), int((homes > 0).sum()) if levels else len(frame)
        unit = _unit(np.stack(frame["embedding"].to_numpy()))
        near = np.zeros((m, m), dtype=bool)
        for at in range(0, h, 512):
            some = slice(at, min(at + 512, h))
            found = unit[some] @ unit.T >= threshold
            found &= (homes[some, None] | homes[None, :]) == levels
            if i < j:  # pairs within block 0 are joined with block 1, those within others with block 0
                within = i == 0 and j == 1, i == 0
                found &= (own[some, None] != own[None, :]) | np.where(own == i, *within)[None, :]
            near[some] |= found
            near[:, some] |= found.T
        np.fill_diagonal(near, False)
        ids = frame["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        root = np.empty(m, dtype=np.int64)
        root[order] = ids[order][linked_within(near[np.ix_(order, order)])]
        n = np.concatenate([near[at : at + 512].astype(np.float64) @ copies.astype(np.float64) for at in range(0, m, 512)])
        some = n > 0
        return pd.DataFrame({"id": ids[some], "n": n[some].astype(np.int64), "root": root[some]})

    rows = distinct.select("label", F.size("embedding").alias("dims"), "id", "copies", "embedding")
    cells = cut_cells(rows, reach)
    key = ["label", "dims", "cell"]
    # a cell without anyone at home has no pairs of its own
    active = (F.col("homes") > 0) | (F.col("levels") == 0)
    counts = cells.groupBy(*key).agg(F.count("*").alias("n"), F.count_if(active).alias("active")).where("n > 1 AND active > 0")
    parts = {"blocks": F.ceil(F.col("active") / BLOCK), "lots": F.ceil((F.col("n") - F.col("active")) / BLOCK)}
    small = F.col("n") <= CELL
    large = settle(counts.select(*key, *(F.when(small, int(c == "blocks")).otherwise(x).cast("int").alias(c) for c, x in parts.items())), "cell-blocks")
    # blocks meet each other and the lots of mere guests; lots do not meet
    hashed = F.xxhash64("id", F.lit("block"))
    own = F.when(active | (F.col("lots") == 0), F.pmod(hashed, F.col("blocks"))).otherwise(F.col("blocks") + F.pmod(hashed, F.col("lots"))).cast("int")
    last = F.when(F.col("own") < F.col("blocks"), F.col("blocks") + F.col("lots")).otherwise(F.col("blocks")) - 1
    spread = cells.join(large, key).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    spread = spread.where("own <> other OR blocks + lots = 1").withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    return spread.drop("other", "blocks", "lots").groupBy(*key, "i", "j").applyInPandas(joined, "id long, n long, root long")


def _far(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * unit @ pivots.T))


def _guests(far: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """In which later cells each vector is a guest, by its distances from the pivots, and its own cell."""
    cell = far.argmin(axis=1)
    near = far - far[np.arange(len(far)), cell][:, None] <= 2 * reach
    return near & (np.arange(far.shape[1])[None, :] > cell[:, None]), cell


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
