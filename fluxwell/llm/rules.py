"""Quality rules: a decision list learned from labelled documents, applied as conditional expressions.

Statistics of a text come from built-in functions in one pass. Rules are grown by sequential covering:
conditions on statistics are added while they make a rule purer, pruned on rows kept aside, and a rule stays
if it is precise there; rows that it covers leave the table, and the next rule is grown. All that reaches
the driver are counts per statistic and bin.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxwell.llm.common import bin_of, let, settle

#: ASCII white space.
SPACE = " \t\n\x0b\x0c\r"
#: Labelled documents that a list is learned from, at most.
SAMPLE = 40_000
#: Labelled documents that are measured for it, at most; their ids are all that is broadcast.
MEASURED = 2 * SAMPLE
BINS = 24
MOST_RULES = 10
MOST_CONDITIONS = 3
#: A rule must reject at least this share rightly among the rows kept aside, and cover so many there.
PRECISION = 0.95
LEAST_COVER = 5

COUNTS = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_distinct n_upper n_digits n_chars".split()
BASE = COUNTS[:5]


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows that occur twice, from the windows' hashes in order."""
    sorted_pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(pairs: Column) -> Column:
        def repeated(pair: Column, j: Column) -> Column:
            before = F.when(j > 0, F.get(pairs, j - 1)["h"] == pair["h"])
            after = F.get(pairs, j + 1)["h"] == pair["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        return F.sort_array(F.transform(F.filter(pairs, repeated), lambda p: p["i"]))

    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("at"))
    covered = F.aggregate(
        let(sorted_pairs, positions),
        start,
        lambda done, p: F.struct((done["n"] + F.least(F.lit(3), p - done["at"])).alias("n"), p.alias("at")),
        lambda done: done["n"],
    )
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(covered)


def statistics(docs: DataFrame, *carried: str) -> DataFrame:
    """``doc_id``, the ``carried`` columns and the statistics ``COUNTS`` (long) of every row of ``docs``.

    Words are runs without ASCII white space; a null text has none. Windows of three words are told apart by
    their 64-bit hashes. Each row is seen once, by built-in functions.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE))

    def windows(words: Column) -> Column:
        at = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def measured(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
        counts = [
            F.size(words),
            F.length(F.array_join(words, "")),
            F.regexp_count(text, F.lit("[#*$%&|<>]")),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
            let(windows(words), _repeat_words),
            F.size(lines),
            F.size(F.array_distinct(words)),
            F.regexp_count(text, F.lit("[A-Z]")),
            F.regexp_count(text, F.lit("[0-9]")),
            F.length(text),
        ]
        return F.struct(*(x.cast("long").alias(name) for name, x in zip(COUNTS, counts, strict=True)))

    split = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    # a generator keeps the struct from being computed again for each of its fields
    return docs.select(F.col("doc_id").cast("long"), *carried, F.inline(F.array(let(split, measured))))


def features() -> dict[str, Column]:
    """Ratios that rules set thresholds on."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / words,
        "dup_lines": F.col("n_dup_lines") / lines,
        "repeats": F.col("n_repeat_words") / words,
        "distinct": F.col("n_distinct") / words,
        "upper": F.col("n_upper") / chars,
        "digits": F.col("n_digits") / chars,
        "line_words": F.col("n_words") / lines,
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.feature) > self.threshold if self.above else F.col(self.feature) <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def matches(rule: Rule) -> Column:
    found = F.lit(True)
    for condition in rule:
        found = found & condition.column()
    return found


def verdict(rules: list[Rule]) -> Column:
    """The first rule that matches, as text, or null: an ordered conditional expression."""
    found = F.lit(None).cast("string")
    for rule in reversed(rules):
        found = F.when(matches(rule), F.lit(" AND ".join(map(str, rule)))).otherwise(found)
    return found


def learn(measured: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """A decision list that rejects what ``labels`` (``doc_id``, ``quality`` 0 or 1) mark 0.

    ``measured`` comes from :func:`statistics`. Rows without a label, with a null or another label, and those
    that fail the base rules teach nothing; of a ``doc_id`` labelled twice the lower label counts. No labels
    give no rules.
    """
    marks = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg((1 - F.min("quality")).alias("bad"))
    names = list(features())
    rows = measured.where(~base_failed()).join(marks, "doc_id").select("doc_id", "bad", *(x.alias(k) for k, x in features().items()))
    rows = settle(rows.orderBy(F.xxhash64("doc_id")).limit(sample), "labelled")
    levels = [(i + 1) / BINS for i in range(BINS - 1)]
    cuts = rows.agg(*(F.percentile_approx(k, levels, 2000).alias(k) for k in names)).first()
    edges = {k: sorted(set(cuts[k] or [])) for k in names}
    bins = [bin_of(F.col(k), edges[k]) for k in names]
    table = settle(rows.withColumn("aside", F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(3)) == 0).withColumn("bins", F.array(*bins)), "binned")

    def count(where: Column) -> tuple[int, int]:
        r = table.where(where).agg(F.sum("bad"), F.count("*")).first()
        return int(r[0] or 0), int(r[1])

    rules: list[Rule] = []
    left = F.lit(True)
    while len(rules) < MOST_RULES:
        rule: Rule = ()
        p, n = count(left & ~F.col("aside"))
        while len(rule) < MOST_CONDITIONS and 0 < p < n:
            inside = table.where(left & ~F.col("aside") & matches(rule))
            cells = inside.select("bad", F.posexplode("bins").alias("f", "bin")).groupBy("f", "bin").agg(F.sum("bad").alias("p"), F.count("*").alias("n")).collect()
            best = _best_condition(names, edges, [(r["f"], r["bin"], r["p"], r["n"]) for r in cells], p, n)
            if best is None:
                break
            condition, p, n = best
            rule += (_with_margin(condition, inside),)
        rule = _prune(rule, lambda r, left=left: count(left & F.col("aside") & matches(r)))
        if not rule:
            break
        p, n = count(left & F.col("aside") & matches(rule))
        if n < LEAST_COVER or p < PRECISION * n:
            break
        rules.append(rule)
        left = left & ~matches(rule)
    return rules


def _best_condition(names: list[str], edges: dict, cells: list[tuple], p0: int, n0: int) -> tuple[Condition, int, int] | None:
    """The condition of the largest gain in information, from counts per statistic and bin."""
    best = None
    for f, name in enumerate(names):
        p = n = 0
        counts = {b: (cp, cn) for g, b, cp, cn in cells if g == f}
        for b, threshold in enumerate(edges[name]):
            p, n = p + counts.get(b, (0, 0))[0], n + counts.get(b, (0, 0))[1]
            for above, cp, cn in ((False, p, n), (True, p0 - p, n0 - n)):
                if cp and cn < n0:
                    gain = cp * (log2(cp / cn) - log2(p0 / n0))
                    if gain > 1e-9 and (best is None or gain > best[0]):
                        best = (gain, Condition(name, above, float(threshold)), cp, cn)
    return best[1:] if best else None


def _with_margin(condition: Condition, inside: DataFrame) -> Condition:
    """Move a threshold halfway towards nineteen in twenty of the rejected rows, away from good ones."""
    edge = 0.05 if condition.above else 0.95
    found = inside.where(condition.column() & (F.col("bad") == 1)).agg(F.percentile_approx(condition.feature, edge, 2000)).first()[0]
    return condition if found is None else Condition(condition.feature, condition.above, (condition.threshold + found) / 2)


def _prune(rule: Rule, count) -> Rule:
    """The shortest beginning of a rule that does best on rows kept aside."""
    best: tuple[float, Rule] = (0.0, ())
    for k in range(1, len(rule) + 1):
        p, n = count(rule[:k])
        worth = (2 * p - n) / n if n else -1.0
        if worth > best[0] + 1e-9:
            best = (worth, rule[:k])
    return best[1]


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and verdict of every row of ``docs`` (``doc_id``, ``text``; more columns are ignored).

    Adds ``base_failed``, ``rule`` (the learned rule that rejects it, or null) and ``kept``. One row per row:
    null ids, null texts (which fail the base rules) and repeated rows included.
    """
    measured = settle(statistics(docs), "statistics")
    return _judged(measured, learn(measured, labels))


def _judged(measured: DataFrame, rules: list[Rule], *carried: str) -> DataFrame:
    scored = measured.select("doc_id", *carried, *COUNTS, *(x.alias(k) for k, x in features().items()))
    scored = scored.select("doc_id", *carried, *COUNTS, base_failed().alias("base_failed"), verdict(rules).alias("rule"))
    return scored.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all their columns and nothing added.

    Rules are learned from the first ``MEASURED`` labelled documents in the order of a hash, so that besides those every
    text is measured once. That leaves :func:`learn` its sample as long as half of them pass the base rules.
    """
    ids = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id").distinct()
    ids = settle(ids.orderBy(F.xxhash64("doc_id")).limit(MEASURED), "labelled-ids")
    labelled = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")
    rules = learn(settle(statistics(labelled), "statistics"), labels)
    whole = F.struct(*(docs[c] for c in docs.columns)).alias("whole_row")
    carried = docs.select("doc_id", "text", whole)
    return _judged(statistics(carried, "whole_row"), rules, "whole_row").where("kept").select("whole_row.*")
