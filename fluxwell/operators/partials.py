"""Statistics as mergeable partials: what to carry per group, how to merge it, how to finish it.

A statistic names the partials it needs. Partials of fine groups merge into those of coarse groups without the
rows, so one scan serves every window size, and a stream and a batch finish the same numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from fluxwell.functions.rounding import round3

#: A metric is a column with the usual statistics, or a column with a list of them.
Metrics = dict[str, str | tuple[str, tuple[str, ...]]]
USUAL = ("avg", "max", "min")


@dataclass(frozen=True)
class Partial:
    """``make`` aggregates readings of a column; ``merge`` aggregates such partials."""

    make: Callable[[Column], Column]
    merge: Callable[[str], Column]


def _spread(x: Column) -> Column:
    """Count, mean and squared deviations of a group, from Spark's own stable variance."""
    n = F.count(x)
    return F.struct(
        n.cast("double").alias("n"),
        F.coalesce(F.avg(x), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(x) * n, F.lit(0.0)).alias("squares"),
    )


def _merged_spread(column: str) -> Column:
    """Pairwise merging, which loses no digits to large means. A list holds one entry per fine window of a coarse one."""

    def pair(a: Column, b: Column) -> Column:
        n, gap = a["n"] + b["n"], b["mean"] - a["mean"]
        share = F.coalesce(F.try_divide(b["n"], n), F.lit(0.0))
        mean, squares = a["mean"] + gap * share, a["squares"] + b["squares"] + gap * gap * a["n"] * share
        return F.struct(n.alias("n"), mean.alias("mean"), squares.alias("squares"))

    zero = F.struct(*(F.lit(0.0).alias(c) for c in ("n", "mean", "squares")))
    return F.reduce(F.collect_list(column), zero, pair)


PARTIALS: dict[str, Partial] = {
    "sum": Partial(F.sum, F.sum),
    "count": Partial(F.count, F.sum),
    "max": Partial(F.max, F.max),
    "min": Partial(F.min, F.min),
    "spread": Partial(_spread, _merged_spread),
    "quantiles": Partial(lambda x: F.kll_sketch_agg_double(x.cast("double")), F.kll_merge_agg_double),
    "values": Partial(lambda x: F.hll_sketch_agg(x.cast("string")), F.hll_union_agg),
}


@dataclass(frozen=True)
class Stat:
    """``finish`` gets a function that looks a partial up by name."""

    partials: tuple[str, ...]
    finish: Callable[[Callable[[str], Column]], Column]


def _variance(get: Callable[[str], Column]) -> Column:
    n = get("spread")["n"]
    return F.when(n > 1, get("spread")["squares"] / F.when(n > 1, n - 1))


def _quantile(rank: float) -> Stat:
    return Stat(("quantiles", "count"), lambda get: F.when(get("count") > 0, F.kll_sketch_get_quantile_double(get("quantiles"), F.lit(rank))))


STATS: dict[str, Stat] = {
    "avg": Stat(("sum", "count"), lambda get: round3(F.try_divide(get("sum"), get("count")))),
    "max": Stat(("max",), lambda get: round3(get("max"))),
    "min": Stat(("min",), lambda get: round3(get("min"))),
    "sum": Stat(("sum",), lambda get: round3(get("sum"))),
    "count": Stat(("count",), lambda get: get("count")),
    "variance": Stat(("spread",), lambda get: round3(_variance(get))),
    "stddev": Stat(("spread",), lambda get: round3(F.sqrt(_variance(get)))),
    "distinct": Stat(("values",), lambda get: F.hll_sketch_estimate(get("values"))),
    "median": _quantile(0.5),
    "p90": _quantile(0.9),
    "p99": _quantile(0.99),
}


def normalized(metrics: Metrics) -> dict[str, tuple[str, tuple[str, ...]]]:
    """Every metric with its column and its list of statistics; unknown ones are refused."""
    out = {}
    for name, wanted in metrics.items():
        column, stats = (wanted, USUAL) if isinstance(wanted, str) else wanted
        unknown = [s for s in stats if s not in STATS]
        if unknown:
            raise ValueError(f"unknown statistics {unknown}; there are {sorted(STATS)}")
        out[name] = (column, tuple(stats))
    return out


def needed(stats: Iterable[str]) -> list[str]:
    """The partials of some statistics, each once, in a fixed order."""
    wanted = {p for s in stats for p in STATS[s].partials}
    return [p for p in PARTIALS if p in wanted]


def columns(metrics: Metrics) -> list[str]:
    """Source columns that the metrics read."""
    return list(dict.fromkeys(column for column, _ in normalized(metrics).values()))


def make(metrics: Metrics) -> list[Column]:
    """Aggregates of readings: one column ``_partial_metric`` per partial."""
    return [PARTIALS[p].make(F.col(column)).alias(f"_{p}_{name}") for name, (column, stats) in normalized(metrics).items() for p in needed(stats)]


def merge(metrics: Metrics) -> list[Column]:
    """Aggregates of partials, under the same names."""
    return [PARTIALS[p].merge(f"_{p}_{name}").alias(f"_{p}_{name}") for name, (_, stats) in normalized(metrics).items() for p in needed(stats)]


def finish(metrics: Metrics) -> list[Column]:
    """The statistics from the partials: one column ``stat_metric`` each, in the order of the lists."""

    def get(name: str) -> Callable[[str], Column]:
        return lambda p: F.col(f"_{p}_{name}")

    return [STATS[s].finish(get(name)).alias(f"{s}_{name}") for name, (_, stats) in normalized(metrics).items() for s in stats]
