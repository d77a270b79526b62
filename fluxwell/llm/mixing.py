"""Mixing to target weights with soft membership.

A classifier fitted on labelled documents gives each document a posterior over domains, so a document counts
partly for several. Nonnegative rates (how often a document should be drawn) are then fitted by projected
gradient steps, so that expected tokens per domain meet the targets with rates as even as possible. A step
needs one sum per domain over all documents; rates are an expression over posteriors, never a stored column.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from math import log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxwell.llm.common import let, settle
from fluxwell.llm.rules import SPACE

#: Labelled documents that the classifier is fitted on, at most, and characters that it counts.
SAMPLE = 2000
MARKERS = 16
#: Domains, at most: sums per domain reach the driver.
MOST_DOMAINS = 64
#: Characters that a text's evidence is worth; more would make every posterior 0 or 1.
EVIDENCE = 60.0
STEPS = 40
CLOSE = 1e-4


@dataclass(frozen=True)
class Classifier:
    """Naive Bayes over counts of marker characters; the rest of a text counts as one more."""

    domains: tuple[str, ...]
    markers: tuple[str, ...]
    #: per domain: log prior, log probability of each marker, of any other character
    logs: tuple[tuple[float, ...], ...]

    def posteriors(self, text: Column) -> Column:
        """An array of one probability per domain."""

        def counts(lower: Column) -> Column:
            size = F.length(lower)
            return F.array(*((size - F.length(F.replace(lower, F.lit(m), F.lit("")))).cast("double") for m in self.markers), size.cast("double"))

        def scores(c: Column) -> Column:
            n = len(self.markers)
            total = F.greatest(F.get(c, n), F.lit(1.0))
            weight = F.least(total, F.lit(EVIDENCE)) / total
            out = []
            for prior, *each, rest in self.logs:
                # what the markers say beyond "any other character", which all characters are at first
                found = F.get(c, n) * rest
                for i, x in enumerate(each):
                    found = found + F.get(c, i) * (x - rest)
                out.append(F.lit(prior) + found * weight)
            return F.array(*out)

        def softmax(s: Column) -> Column:
            shifted = F.transform(s, lambda x: F.exp(x - F.array_max(s)))
            return let(shifted, lambda e: let(F.aggregate(e, F.lit(0.0), lambda a, b: a + b), lambda t: F.transform(e, lambda x: x / t)))

        return let(let(let(F.lower(F.coalesce(text, F.lit(""))), counts), scores), softmax)


def classify(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> Classifier:
    """Fit on a sample of ``docs`` (``doc_id``, ``text``) that ``labelled`` (``doc_id``, ``domain``) names.

    Null ids and domains not in ``domains`` teach nothing. Without labelled rows all domains are as likely.
    """
    if not 0 < len(domains) <= MOST_DOMAINS:
        raise ValueError(f"between 1 and {MOST_DOMAINS} domains, not {len(domains)}")
    known = labelled.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    known = known.orderBy(F.xxhash64("doc_id")).limit(SAMPLE)
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("domain", F.lower("text").alias("text"))
    texts = settle(texts, "labelled")
    prior = dict(texts.groupBy("domain").count().collect())
    letters = texts.select("domain", F.explode(F.split("text", "")).alias("letter")).where("letter <> ''").groupBy("domain", "letter").count()
    letters = settle(letters, "letters")
    common = [r[0] for r in letters.groupBy("letter").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "letter").limit(256).collect()]
    counts = {(r["domain"], r["letter"]): r["count"] for r in letters.where(F.col("letter").isin(common)).collect()}
    sizes = dict(letters.groupBy("domain").agg(F.sum("count")).collect())
    share = {(d, c): (counts.get((d, c), 0) + 0.5) / (sizes.get(d, 0) + 0.5 * len(common) + 1) for d in domains for c in common}
    mean = {c: sum(share[d, c] for d in domains) / len(domains) for c in common}
    told = {c: sum(share[d, c] * log(share[d, c] / mean[c]) for d in domains) for c in common}
    markers = sorted(sorted(common, key=lambda c: (-told[c], c))[:MARKERS])
    every = sum(prior.values()) + len(domains)
    logs = []
    for d in domains:
        rest = max(1e-9, 1 - sum(share[d, m] for m in markers))
        logs.append((log((prior.get(d, 0) + 1) / every), *(log(share[d, m]) for m in markers), log(rest)))
    return Classifier(tuple(domains), tuple(markers), tuple(logs))


def n_tokens(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def rate(p: Column, steps: list[list[float]]) -> Column:
    """The rate after projected steps, each of which takes a weight per domain off, from a rate of one."""
    x = F.lit(1.0)
    for step in steps:
        for k, value in enumerate(step):
            x = x - F.get(p, k) * value
        x = F.greatest(x, F.lit(0.0))
    return x


def fit(members: DataFrame, weights: list[float], total: float | None = None) -> list[list[float]]:
    """Steps for :func:`rate`, from ``members`` (``n_tokens``, ``p``) and a weight per domain.

    Minimises the squared relative misses of the domains' token totals; distances between rates are weighed by
    tokens, so that rates depend on posteriors and not on length. Without ``total`` it is the smallest at which
    no domain has to lose tokens, so that nothing is thrown away. Stops when each total is within ``CLOSE`` of its
    target, and warns where ``STEPS`` steps don't get there, as with targets that no rates can meet.
    """
    k = len(weights)
    have = [F.sum(F.col("n_tokens") * F.get("p", i)) for i in range(k)]
    gram = [F.sum(F.col("n_tokens") * F.get("p", i) * F.get("p", j)) for i in range(k) for j in range(k)]
    first = [float(x or 0) for x in members.agg(*(c.alias(f"c{i}") for i, c in enumerate([*have, *gram]))).first()]
    sums, gram = first[:k], [first[k + i * k : k + (i + 1) * k] for i in range(k)]
    shares = [w / sum(weights) for w in weights]
    total = total or max([s / w for s, w in zip(sums, shares, strict=True) if w > 0], default=0.0)
    targets = [w * total for w in shares]
    scale = [sqrt(gram[i][i]) or 1.0 for i in range(k)]
    # no step larger than the inverse of the largest sum of a row, a bound of the largest eigenvalue
    size = 1 / max([sum(abs(gram[i][j]) / (scale[i] * scale[j]) for j in range(k)) for i in range(k)] + [1e-12])
    steps: list[list[float]] = []
    while True:
        misses = [s - t for s, t in zip(sums, targets, strict=True)]
        far = max((abs(m) / max(t, total / 1000, 1) for m, t in zip(misses, targets, strict=True)), default=0.0)
        if far <= CLOSE:
            break
        if len(steps) == STEPS:
            warnings.warn(f"after {STEPS} steps a domain's tokens miss their target by {far:.2%}", RuntimeWarning, stacklevel=2)
            break
        steps.append([size * m / scale[i] ** 2 for i, m in enumerate(misses)])
        x = members.select("n_tokens", "p", rate(F.col("p"), steps).alias("x"))
        sums = [float(v or 0) for v in x.agg(*(F.sum(F.col("n_tokens") * F.col("x") * F.get("p", i)).alias(f"c{i}") for i in range(k))).first()]
    return steps


def copies(x: Column, *key: Column | str) -> Column:
    """A whole number of draws whose mean over rows is the rate, to thousandths; a hash of ``key`` decides the fraction."""
    lot = F.pmod(F.xxhash64(*key, F.lit("draw")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return F.floor(F.round(x, 3) + lot).cast("long")


def model(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], total: float | None = None) -> tuple[Classifier, list[list[float]], DataFrame]:
    """Classifier, steps, and the members (``doc_id``, ``n_tokens``, ``p``, ``lot_key``) they were fitted on."""
    domains = sorted(targets)
    classifier = classify(docs, labelled, domains)
    members = settle(docs.select("doc_id", n_tokens(F.col("text")).alias("n_tokens"), classifier.posteriors(F.col("text")).alias("p"), F.xxhash64("text").alias("lot_key")), "members")
    return classifier, fit(members, [targets[d] for d in domains], total), members


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], total: float | None = None) -> DataFrame:
    """Rates for every row of ``docs`` (``doc_id``, ``text``; more columns are ignored).

    ``targets`` gives each domain's weight. Returns ``doc_id``, ``n_tokens`` (words), ``p_<domain>``, ``rate`` and
    ``copies`` (whole draws). One row per row: a null text has no tokens and gets the prior; null ids stay
    null; repeated rows count each and get the same number of copies. No rows give none.
    """
    classifier, steps, members = model(docs, labelled, targets, total)
    x = members.select("*", rate(F.col("p"), steps).alias("rate"))
    return x.select("doc_id", "n_tokens", *(F.get("p", i).alias(f"p_{d}") for i, d in enumerate(classifier.domains)), "rate", copies(F.col("rate"), "doc_id", "lot_key").alias("copies"))


def drawn(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], total: float | None = None) -> DataFrame:
    """``docs`` with each row as often as :func:`mix` says, and nothing else changed.

    Rows are written with their posteriors once; fitting reads the posteriors alone, and drawing the rows.
    """
    domains = sorted(targets)
    posteriors = classify(docs, labelled, domains).posteriors(F.col("text"))
    row = F.struct(*docs.columns).alias("row")
    held = docs.select(row, n_tokens(F.col("text")).alias("n_tokens"), posteriors.alias("p"), F.xxhash64("text").alias("lot_key"))
    held = settle(held, "held")
    steps = fit(held.select("n_tokens", "p"), [targets[d] for d in domains], total)
    times = copies(rate(F.col("p"), steps), "row.doc_id", "lot_key")
    # a generator keeps the number of draws from being computed for the filter and again for the draws
    often = held.select("row", F.inline(F.array(F.struct(times.alias("times"))))).where("times > 0")
    return often.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("draw")).select("row.*")
