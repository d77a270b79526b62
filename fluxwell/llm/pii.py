"""Personal data: base rules, and spans that gradient-boosted trees add.

Generators of high recall propose spans, which may overlap. Four of them are the base rules' patterns, whose
valid matches always stay. Trees over the format and the surroundings of a span are boosted on weak labels
(valid base matches, and values assigned to names of secrets), and a threshold calibrated on spans kept aside
selects what is added. Positions come from the lengths of what lies between matches, summed by a window.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluxwell.llm.common import bin_of, let, settle

#: Patterns of the generators, in the order that breaks ties. Runs are possessive and start where the run
#: before them ends, so that long runs neither recurse nor are tried from each of their characters.
GENERATORS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "local": r"(?<![0-9])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,}+={0,2}+",
}
KINDS = ("email", "ip", "card", "phone")
#: Names that a secret is assigned to.
NAMED = r"(?i)(?:token|secret|password|passwd|pwd|credential|api_?key|access_?key|auth)[\x20\"']*[=:]+[\x20\"']*$"
#: A national number that could be dialled, the country code before it, and what makes it a part of a longer number.
NATIONAL = r"^\(?[2-9][0-9]{2}\)?[\x20.-][2-9][0-9]{2}[\x20.-][0-9]{4}$"
COUNTRY = r"\+[0-9]{1,3}[\x20(.-]*$"
LONGER = (r"[0-9][\x20.-]?$", r"^[\x20.-]?[0-9]")
#: Spans that trees are fitted on: about this many, and of each generator and label an equal share at most. Spans of
#: a stratum above its share are drawn by hash and weigh as many as they stand for.
SAMPLE = 60_000
ROUNDS = 10
BINS = 16
RATE = 0.4
#: A threshold must be right this often among the spans kept aside.
PRECISION = 0.95


def hits(text: Column) -> Column:
    """All matches of all generators: generator, number, match, characters since the last one, surroundings."""

    def of(number: int, pattern: str) -> Column:
        def located(found: Column, between: Column) -> Column:
            return F.transform(
                found,
                lambda x, k: F.struct(
                    F.lit(number).alias("gen"),
                    k.alias("k"),
                    x.alias("match"),
                    F.length(F.get(between, k)).cast("long").alias("gap"),
                    F.right(F.concat(F.when(k > 0, F.get(found, k - 1)).otherwise(""), F.get(between, k)), F.lit(24)).alias("before"),
                    F.left(F.get(between, k + 1), F.lit(8)).alias("after"),
                ),
            )

        none = F.array().cast("array<struct<gen:int,k:int,match:string,gap:bigint,before:string,after:string>>")
        some = lambda found: let(F.split(text, pattern), lambda between: located(found, between))
        return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) == 0, none).otherwise(some(found)))

    return F.concat(*(of(i, pattern) for i, pattern in enumerate(GENERATORS.values())))


def _valid() -> Column:
    """Whether a match of a base pattern passes its check."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    reverse = F.split(F.reverse(digits), "")
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    luhn = F.aggregate(
        F.transform(F.filter(reverse, lambda x: x != ""), lambda x, i: F.when(i % 2 == 1, doubled(x.cast("int"))).otherwise(x.cast("int"))),
        F.lit(0),
        lambda a, b: a + b,
    )
    gen = F.col("gen")
    return (
        F.when(gen == 0, True)
        .when(gen == 1, F.col("match").rlike(rf"^{part}(?:\.{part}){{3}}$"))
        .when(gen == 2, F.when(F.length(digits).between(14, 19), luhn % 10 == 0).otherwise(False))
        .when(gen == 3, F.length(digits).between(10, 15))
        .otherwise(False)
    )


def spans(docs: DataFrame, *carried: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` (``row``, ``doc_id``, ``carried``), and their candidate spans.

    A candidate has ``row``, ``gen``, ``match``, ``start``, ``end`` (code points, end exclusive), ``before``,
    ``after`` and ``base`` (a valid match of a base rule). A null text has none.
    """
    found = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        *carried,
        hits(F.coalesce(F.col("text"), F.lit(""))).alias("hits"),
    )
    found = settle(found, "hits")
    each = found.select("row", F.inline("hits")).repartition("row")
    passed = Window.partitionBy("row", "gen").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("match").cast("long")
    each = each.withColumn("end", F.sum(F.col("gap") + size).over(passed))
    each = each.select("row", "gen", "match", (F.col("end") - size).alias("start"), "end", "before", "after", _valid().alias("base"))
    return found.drop("hits"), settle(each, "spans")


def features() -> dict[str, Column]:
    """Format and surroundings of a span, as numbers; none of them is the check that base rules use."""
    match = F.col("match")
    size = F.length(match)
    share = lambda p: F.regexp_count(match, F.lit(p)) / size
    return {
        "gen": F.col("gen").cast("double"),
        "size": size.cast("double"),
        "digits": F.regexp_count(match, F.lit("[0-9]")).cast("double"),
        "digit_share": share("[0-9]"),
        "letter_share": share("[A-Za-z]"),
        "hex_share": share("[0-9a-f]"),
        "upper_share": share("[A-Z]"),
        "dots": F.regexp_count(match, F.lit(r"\.")).cast("double"),
        "breaks": F.regexp_count(match, F.lit(r"[\x20()-]")).cast("double"),
        "at": F.regexp_count(match, F.lit("@")).cast("double"),
        "quoted": (F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).cast("double"),
        "assigned": F.col("before").rlike("[=:][\\x20\"']*$").cast("double"),
        "glued": (F.col("before").rlike("[A-Za-z0-9]$") | F.col("after").rlike("^[A-Za-z0-9]")).cast("double"),
        "mixed": F.least(F.regexp_count(match, F.lit("[0-9][A-Za-z]")), F.lit(9)).cast("double"),
    }


@dataclass(frozen=True)
class Tree:
    """Two levels of splits; ``values`` are the leaves from left to right."""

    root: tuple[str, float]
    branches: tuple[tuple[str, float] | None, tuple[str, float] | None]
    values: tuple[float, float, float, float]

    def column(self) -> Column:
        def side(branch, low: float, high: float) -> Column:
            return F.when(F.col(branch[0]) <= branch[1], low).otherwise(high) if branch else F.lit(low)

        left, right = (side(b, *self.values[2 * i : 2 * i + 2]) for i, b in enumerate(self.branches))
        return F.when(F.col(self.root[0]) <= self.root[1], left).otherwise(right)


def margin(trees: list[Tree], start: float) -> Column:
    total = F.lit(start)
    for tree in trees:
        total = total + tree.column()
    return total


def probability(trees: list[Tree], start: float) -> Column:
    return 1 / (1 + F.exp(-margin(trees, start)))


def _best_split(cells: list, names: list[str], edges: dict) -> tuple | None:
    """The split of the largest gain, from sums of gradients per statistic and bin."""
    best = None
    worth = lambda g, h: g * g / (h + 1.0)
    for f, name in enumerate(names):
        own = {r["bin"]: (r["g"], r["h"]) for r in cells if r["f"] == f}
        all_g, all_h = (sum(x[i] for x in own.values()) for i in (0, 1))
        g = h = 0.0
        for b, threshold in enumerate(edges[name]):
            g, h = g + own.get(b, (0, 0))[0], h + own.get(b, (0, 0))[1]
            gain = worth(g, h) + worth(all_g - g, all_h - h) - worth(all_g, all_h)
            if gain > 1e-6 and (best is None or gain > best[0]):
                best = (gain, (name, float(threshold)), (g, h), (all_g - g, all_h - h))
    return best


def label() -> Column:
    """The weak label of a candidate, 0 or 1.

    A national number is one where it could be dialled and is no part of a longer number, and where a country code
    before it makes it the inside of a valid phone.
    """
    before, ended = F.col("before"), ~F.col("after").rlike(LONGER[1])
    local = F.col("gen") == list(GENERATORS).index("local")
    alone = F.col("match").rlike(NATIONAL) & ~before.rlike(LONGER[0])
    national = local & ended & (alone | before.rlike(COUNTRY))
    return (F.col("base") | national | F.col("before").rlike(NAMED)).cast("int")


def fit(candidates: DataFrame, sample: int = SAMPLE) -> tuple[list[Tree], float, float]:
    """Trees, their start and the calibrated threshold, from candidate spans.

    Trees learn from a sample of three quarters of the candidates, stratified by generator and label. The threshold
    comes from counts over all of the other quarter. Without candidates of both kinds nothing is added.
    """
    names = list(features())
    lot = F.xxhash64("match", "before", "row", "start")
    aside = F.pmod(lot, F.lit(4)) == 0
    every = candidates.select(label().alias("y"), lot.alias("lot"), aside.alias("aside"), *(x.alias(k) for k, x in features().items()))
    every = settle(every, "labelled")
    share = sample / (2 * len(GENERATORS))
    strata = every.where("NOT aside").groupBy("gen", "y").agg(F.count("*").alias("n")).collect()
    rate = weight = F.lit(None).cast("double")
    for r in strata:
        own = (F.col("gen") == r["gen"]) & (F.col("y") == r["y"])
        rate, weight = F.when(own, min(1.0, share / r["n"])).otherwise(rate), F.when(own, max(1.0, r["n"] / share)).otherwise(weight)
    drawn = F.pmod(F.xxhash64("lot", F.lit("stratum")), F.lit(1_000_003)) / F.lit(1_000_003.0) < rate
    rows = settle(every.where("NOT aside").where(drawn).withColumn("weight", weight), "sampled")
    levels = [(i + 1) / BINS for i in range(BINS - 1)]
    cuts = rows.agg(*(F.percentile_approx(k, levels, 2000).alias(k) for k in names), F.count("*").alias("n")).first()
    total = sum(r["n"] for r in strata)
    mean = sum(r["n"] * r["y"] for r in strata) / total if total and cuts["n"] else None
    if mean is None or not 0 < mean < 1:
        return [], 0.0, 2.0
    edges = {k: sorted(set(cuts[k])) for k in names}
    bins = [bin_of(F.col(k), edges[k]) for k in names]
    table = settle(rows.withColumn("bins", F.array(*bins)), "binned")
    trees: list[Tree] = []
    start = _logit(mean)
    for _ in range(ROUNDS):
        p = probability(trees, start)
        steps = table.select("*", (F.col("weight") * (F.col("y") - p)).alias("g"), (F.col("weight") * p * (1 - p)).alias("h"))

        def cells(side: Column, steps: DataFrame = steps) -> dict[int, list]:
            every = steps.select(side.alias("side"), "g", "h", F.posexplode("bins").alias("f", "bin"))
            found: dict[int, list] = {0: [], 1: []}
            for r in every.groupBy("side", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
                found[r["side"]].append(r)
            return found

        root = _best_split(cells(F.lit(0))[0], names, edges)
        if root is None:
            break
        _, (name, threshold), *sums = root
        parts = cells(F.when(F.col(name) <= threshold, 0).otherwise(1))
        branches, values = [], []
        for i in (0, 1):
            split = _best_split(parts[i], names, edges)
            branches.append(split[1] if split else None)
            values += [RATE * g / (h + 1.0) for g, h in (split[2:] if split else (sums[i], sums[i]))]
        trees.append(Tree((name, threshold), tuple(branches), tuple(values)))
    score = F.floor(probability(trees, start) * 1000).cast("int")
    counts = every.where("aside").groupBy(score.alias("score")).agg(F.sum("y").alias("p"), F.count("*").alias("n")).collect()
    p = n = 0
    threshold = 2.0
    for r in sorted(counts, key=lambda r: -r["score"]):
        p, n = p + r["p"], n + r["n"]
        if p >= PRECISION * n:
            threshold = r["score"] / 1000
    return trees, start, max(threshold, 0.5)


def _logit(x: float) -> float:
    from math import log

    return log(x / (1 - x)) if exp(-30) < x < 1 else 0.0


def select(candidates: DataFrame, model: tuple[list[Tree], float, float]) -> DataFrame:
    """Base spans, and those that the trees add: ``row``, ``kind``, ``start``, ``end``, ``base``.

    Added spans may overlap base spans and each other, so that all of a secret is covered whatever else it holds; one
    that lies within another span that was found adds nothing and is left out, of equal ones all but the first.
    """
    trees, start, threshold = model
    scored = candidates.select("row", "gen", "start", "end", "base", *(x.alias(k) for k, x in features().items() if k != "gen"))
    chosen = scored.withColumn("chosen", F.col("base") | (probability(trees, start) >= threshold)).where("chosen").select("row", "gen", "start", "end", "base")
    order = Window.partitionBy("row").orderBy("start", F.desc("end"), F.desc("base"), "gen")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    free = chosen.withColumn("reached", reached).where("base OR reached IS NULL OR reached < end")
    kind = F.element_at(F.array(*map(F.lit, GENERATORS)), F.col("gen") + 1)
    return free.select("row", "gen", kind.alias("kind"), "start", "end", "base")


def find(docs: DataFrame) -> DataFrame:
    """Personal data in every row of ``docs`` (``doc_id``, ``text``; more columns are ignored).

    Returns ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (valid base matches), ``base`` and ``spans``
    (arrays of ``start``, ``gen``, ``kind``, ``end`` in order). One row per row: null ids, null and empty texts
    (which have no spans) and repeated rows included.
    """
    rows, selected = _found(docs)
    return rows.join(_gathered(selected), "row", "left").select("doc_id", *_columns())


def _found(docs: DataFrame, *carried: str) -> tuple[DataFrame, DataFrame]:
    rows, candidates = spans(docs, *carried)
    return rows, select(candidates, fit(candidates))


def _gathered(selected: DataFrame) -> DataFrame:
    one = F.struct("start", "gen", "kind", "end")
    counts = [F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS]
    return selected.groupBy("row").agg(*counts, F.sort_array(F.collect_list(F.when(F.col("base"), one))).alias("base"), F.sort_array(F.collect_list(one)).alias("spans"))


def _columns() -> list[Column]:
    none = F.array().cast("array<struct<start:bigint,gen:int,kind:string,end:bigint>>")
    return [*(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS), *(F.coalesce(k, none).alias(k) for k in ("base", "spans"))]


def joined(found: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of its text replaced by its kind in brackets; all other columns stay.

    Spans that overlap are replaced together, under the kind of the first. ``n_chars``, where ``docs`` has it,
    becomes the new length. Null texts stay null. Rows meet their spans by ``doc_id`` and a hash of the text,
    of which spans are a function, so repeated rows and null ids are served alike.
    """
    rows, selected = _found(docs.withColumn("text_hash", F.xxhash64("text")), "text_hash")
    order = Window.partitionBy("row").orderBy("start", "gen")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached.isNull() | (reached <= F.col("start")), 1).otherwise(0)
    merged = selected.withColumn("opens", opens).withColumn("island", F.sum("opens").over(order))
    islands = merged.groupBy("row", "island").agg(F.min(F.struct("start", "gen", "kind")).alias("first"), F.max("end").alias("end"))
    cuts = islands.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(F.col("first.start").alias("start"), "end", F.upper("first.kind").alias("kind")))).alias("cuts"))
    named = rows.join(cuts, "row").select(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), "cuts").dropDuplicates(["own_id", "own_hash"])
    met = docs.join(named, docs["doc_id"].cast("long").eqNullSafe(named["own_id"]) & (F.xxhash64(docs["text"]) == named["own_hash"]), "left")
    text, found = docs["text"], F.col("cuts")
    pieces = F.transform(
        found,
        lambda s, i: F.concat(_slice(text, F.when(i > 0, F.get(found, i - 1)["end"]).otherwise(0), s["start"]), F.lit("["), s["kind"], F.lit("]")),
    )
    last = F.element_at(found, -1)["end"]
    new = F.when(found.isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), _slice(text, last, F.length(text))))
    out = [new.alias("text") if c == "text" else docs[c] for c in docs.columns]
    done = met.select(*out)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def _slice(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))
