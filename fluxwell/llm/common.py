"""Helpers that the operators of this package share: shared folders, cutting lineage, components, let-bindings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from weakref import WeakKeyDictionary

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_DIRS: list[str] = []

#: Folders of the tables that :func:`settle` wrote.
SETTLED: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()

#: With it a write drops its shuffle files at its end; otherwise they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a temporary folder; a cluster gets an error,
    because its executors could not see such a folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not LOCAL_DIRS:
        LOCAL_DIRS.append(tempfile.mkdtemp(prefix="fluxwell-"))
    return LOCAL_DIRS[0]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Lineage ends there, so a lost executor costs a read and never a recomputation, and values that
    depend on partitioning (row ids, names of side files) stay as they were written. What was shuffled
    for it is not kept.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    settled = spark.read.schema(df.schema).parquet(path)
    SETTLED[settled] = path
    return settled


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`settle` wrote and that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(SETTLED.pop(table))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def column_or(df: DataFrame, name: str, kind: str, default: Column) -> Column:
    """Column ``name`` cast to ``kind``, with nulls replaced by ``default``."""
    return F.coalesce(df[name].cast(kind), default)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``.

    A lambda reads outer expressions again for each element; a one-element array makes the value a
    lambda variable instead, which is computed once per row.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def bin_of(value: Column, edges: list[float]) -> Column:
    """How many of the ``edges`` a value lies above."""
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda edge: value > edge)) if edges else F.lit(0)


def linked_within(adjacent: np.ndarray) -> np.ndarray:
    """For each index of a boolean, symmetric matrix the smallest index that it reaches."""
    m = len(adjacent)
    root = np.arange(m)
    seen = np.zeros(m, dtype=bool)
    degree = adjacent.sum(axis=1) - adjacent.diagonal()
    seen[degree == 0] = True
    for start in np.flatnonzero(~seen):
        if seen[start]:
            continue
        frontier = np.array([start])
        seen[start] = True
        while len(frontier):
            root[frontier] = start
            frontier = np.flatnonzero(adjacent[frontier].any(axis=0) & ~seen)
            seen[frontier] = True
    return root


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of the undirected ``links`` (two long columns).

    Returns ``node`` and ``component``, the smallest node that it reaches, for every node of a link
    between two different nodes. Nulls are no nodes; repeated links count once; no links give no rows.

    Each round every node takes its smallest neighbour as parent, parents are followed twice, and links
    are redrawn between the nodes that are left. Rows only meet in joins on a node, whose large side
    adaptive execution may split, and in minima that are taken before the shuffle.
    """
    spark = links.sparkSession
    pairs = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    pairs = pairs.where("u <> v")
    edges = settle(pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    found: DataFrame | None = None
    while not edges.isEmpty():
        parent = settle(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("up")), "parent")
        for _ in range(2):
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            parent = settle(parent.join(above, "up").select("node", F.col("top").alias("up")), "parent")
        if found is None:
            found = parent
        else:
            step = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            found = settle(found.join(step, "up", "left").select("node", F.coalesce("top", "up").alias("up")), "found")
        left = parent.select(F.col("node").alias("u"), F.col("up").alias("u2"))
        right = parent.select(F.col("node").alias("v"), F.col("up").alias("v2"))
        half = settle(edges.join(left, "u").select(F.col("u2").alias("u"), "v"), "half")
        edges = settle(half.join(right, "v").select("u", F.col("v2").alias("v")).where("u <> v").distinct(), "edges")
    if found is None:
        return spark.createDataFrame([], "node long, component long")
    return found.select("node", F.col("up").alias("component"))
