"""Repeats of bytes, ranked search and the filter audit against plain Python, and their results on odd inputs."""

from __future__ import annotations

import random
import re
import time
from collections import Counter, defaultdict
from itertools import permutations
from math import floor, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluxwell.llm import audit, common, ranking, suffixes

DOCS = "doc_id long, text string, lang string, row string, part string, n long, hash long, spans string"
SHARED = " ".join(f"shared{i}passage" for i in range(60))


def frame_of(spark, texts, langs=None):
    langs = langs or [None] * len(texts)
    return spark.createDataFrame([(i, t, x, "row", "part", 7, 7, "spans") for i, (t, x) in enumerate(zip(texts, langs, strict=True))], DOCS)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    line = lambda n: " ".join(f"w{r.randrange(900)}" for _ in range(n))
    base = [line(r.randrange(30, 400)) for _ in range(12)]
    near = []
    for text in base[:6]:
        for _ in range(4):
            own = text.split()
            for _ in range(r.randrange(1, 4)):
                own[r.randrange(len(own))] = "edité"
            near.append(" ".join(own))
    mixed = [line(r.randrange(40)) + " " + SHARED[: r.choice((399, 400, 401, 700))] + line(r.randrange(40)) for _ in range(30)]
    odd = [None, "", " ", "a", "x" * 3000, "ab" * 900, "é" * 250, base[0], base[0], SHARED + SHARED, "\x00\n" * 300]
    return [*base, *near, *mixed, *odd]


def repeats(raws):
    """Removed spans of each text: bytes of windows that start at two places at least."""
    times = Counter(raw[i : i + 400] for raw in raws for i in range(len(raw) - 399))
    out = []
    for raw in raws:
        spans = []
        for i in range(len(raw) - 399):
            if times[raw[i : i + 400]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + 400
                else:
                    spans.append([i, i + 400])
        out.append(spans)
    return out


@pytest.mark.parametrize(("batches", "stretch"), [(1, suffixes.STRETCH), (5, 700)])
def test_repeats_equal_brute_force(spark, texts, batches, stretch):
    docs = frame_of(spark, texts).repartition(3)
    raws = [(t or "").encode() for t in texts]
    expected = repeats(raws)
    found = {r["doc_id"]: r for r in suffixes.remove_repeats(docs, batches, stretch).collect()}
    assert len(found) == len(texts)
    for i, raw in enumerate(raws):
        assert [[s["start"], s["end"]] for s in found[i]["spans"]] == expected[i], i
        kept, at = b"", 0
        for start, end in expected[i]:
            kept, at = kept + raw[at:start], end
        assert bytes(found[i]["kept"]) == kept + raw[at:] and found[i]["n_bytes"] == len(raw)
    assert sum(map(len, expected)) > 40


def test_repeats_of_repeated_rows(spark, texts):
    docs = frame_of(spark, [texts[0], texts[1]])
    found = suffixes.remove_repeats(docs.union(docs)).collect()
    assert [len(r["kept"]) for r in found] == [0 if len(r) >= 400 else len(r) for r in map(str.encode, (texts[0], texts[1], texts[0], texts[1]))]
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0
    nameless = docs.selectExpr("CAST(NULL AS bigint) AS doc_id", "text")
    assert [r["doc_id"] for r in suffixes.remove_repeats(nameless).collect()] == [None, None]


def test_levels_of_the_index(spark, texts):
    index = suffixes.SuffixIndex()
    marked = suffixes.marks(frame_of(spark, texts))
    sizes = []
    for k in range(5):
        index.add(suffixes.entries(marked.where(f"doc_id % 5 = {k}")))
        sizes.append(sorted(index.levels))
    assert sizes == [[0], [1], [0, 1], [2], [0, 2]]
    whole = suffixes.SuffixIndex()
    whole.add(suffixes.entries(marked))
    key = lambda index: sorted((r["sig"], r["ctx"], r["n"]) for r in index.repeated().collect())
    assert key(index) == key(whole)


def shuffled(spark):
    """Names of the shuffle files on disk."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {x for x in blocks.mkString(",").split(",") if x.startswith("shuffle_")}


def left_over(spark, before):
    """Shuffle files that are not in ``before`` and don't go; Spark removes them in the background."""
    end = time.time() + 10
    while (found := shuffled(spark) - before) and time.time() < end:
        time.sleep(0.1)
    return found


def test_settled_tables_keep_no_shuffle_files(spark):
    before = shuffled(spark)
    counts = spark.range(1000, numPartitions=4).groupBy((F.col("id") % 7).alias("k")).count()
    found = common.settle(counts)
    assert not left_over(spark, before)
    assert spark.conf.get(common.CLEANUP, None) is None
    assert sorted(r["count"] for r in found.collect()) == [142] + [143] * 6
    spark.conf.set(common.CLEANUP, "false")
    try:
        common.settle(counts)
        assert spark.conf.get(common.CLEANUP) == "false" and not left_over(spark, before)
    finally:
        spark.conf.unset(common.CLEANUP)


def test_only_settled_tables_are_discarded(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/given")
    given = spark.read.parquet(f"{tmp_path}/given")
    with pytest.raises(KeyError):
        common.discard(given)
    assert given.count() == 3


def test_repeats_leave_one_table(spark, texts, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "new_path", lambda spark, name: f"{tmp_path}/{name}-{time.time_ns()}")
    docs = frame_of(spark, texts).repartition(3)
    before = shuffled(spark)
    found = suffixes.remove_repeats(docs)
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["spans"]
    assert not left_over(spark, before)
    assert [bool(r["spans"]) for r in found.orderBy("doc_id").collect()] == [bool(x) for x in repeats([(t or "").encode() for t in texts])]


def test_sampled_places_are_a_matter_of_the_window(texts):
    r = random.Random(2)
    for _ in range(20):
        window = bytes(r.choice(b"ab c") for _ in range(400))
        places = {int(suffixes.sampled(np.frombuffer(bytes(r.randrange(256) for _ in range(k)) + window + b"tail" * 200, np.uint8))[k]) - k for k in (0, 1, 77, 500)}
        assert len(places) == 1 and 0 <= places.pop() < suffixes.SAMPLED


def plain_search(texts, items):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    docs = [Counter(terms(t)) for t in texts]
    n = [sum(d.values()) for d in docs]
    documents, length = sum(x > 0 for x in n), sum(n)
    df = Counter(t for d in docs for t in d)
    out = []
    for item, text in items:
        scores = []
        for i, d in enumerate(docs):
            m = 50 + 50 * n[i] * documents // length
            score = sum(floor(1000 * log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * d[t] // (1000 * d[t] + 20 * m)) for t in set(terms(text)) if t in d)
            scores.append((-score, i))
        out += [(item, k + 1, i, -s) for k, (s, i) in enumerate(sorted(x for x in scores if x[0])[:50])]
    return sorted(out, key=str)


def test_ranked_search_equals_brute_force(spark):
    r = random.Random(4)
    words = [f"Wort{i}" for i in range(60)] + ["Élan", "naïve", "x_y", "a1", "Ωmega"]
    texts = [" ".join(r.choice(words) for _ in range(r.choice((1, 5, 60, 600)))) for _ in range(300)] + ["wort1 " * 700, "wort1 " * 255, "", None, "--"]
    texts += texts[:40]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randrange(1, 12)))) for i in range(9)] + [(9, None), (10, "nothing"), (3, "wort1 wort1"), (None, "élan ÉLAN")]
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, doc_id string, score int")
    docs = frame_of(spark, texts).repartition(4)
    expected = plain_search(texts, items)
    key = lambda rows: sorted(((x["item_id"], x["rank"], x["doc_id"], x["score"]) for x in rows), key=str)
    assert key(ranking.search(ranking.index(docs), asked).collect()) == expected
    # narrow sketches give loose bounds, small blocks and batches many rounds
    assert key(ranking.search(ranking.index(docs, width=4), asked, batch_rows=4, block=16).collect()) == expected


def test_ranked_search_scores_few_documents(monkeypatch):
    """Bounds let nearly all documents go unscored once the best are known."""
    r = random.Random(9)
    import pandas as pd
    import xxhash

    def row(i, text):
        own = Counter(ranking.terms_of(text.encode()))
        sketch = np.zeros(ranking.WIDTH, np.uint8)
        for t, n in own.items():
            at = xxhash.xxh64_intdigest(t) % ranking.WIDTH
            sketch[at] = max(sketch[at], min(n, 255))
        return (i, i, sum(own.values()), b" ".join(own), np.array(list(own.values()), "<u4").tobytes(), sketch.tobytes())

    rows = [row(i, " ".join(f"t{r.randrange(5000)}" for _ in range(80)) + " rare" * (i % 40 == 0)) for i in range(2000)]
    frame, scored = pd.DataFrame(rows, columns=["row", "doc_id", "n", "terms", "counts", "sketch"]), []
    plain = ranking.impact
    monkeypatch.setattr(ranking, "impact", lambda tf, m: (scored.append(1) if isinstance(tf, int) else None, plain(tf, m))[1])
    lookup = np.zeros((ranking.WIDTH, 1))
    lookup[xxhash.xxh64_intdigest(b"rare") % ranking.WIDTH, 0] = 5000
    best = [[]]
    ranking._search_block(frame, [(0, {b"rare": 5000})], lookup, 2000, 160_050, 50, best)
    assert {-x[2] for x in best[0]} == set(range(0, 2000, 40)) and len(scored) <= 60


def test_ranked_search_odd_tables(spark):
    docs = spark.createDataFrame([(None, "same words"), (5, "same words"), (5, "same words"), (4, "same words")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "words")], "item_id long, text string")
    assert [r["doc_id"] for r in ranking.search(ranking.index(docs), asked).orderBy("rank").collect()] == [4, 5, 5, None]
    assert ranking.search(ranking.index(docs.limit(0)), asked).count() == 0
    assert ranking.search(ranking.index(docs), asked.limit(0)).count() == 0


def plain_audit(rows, good, toxic):
    """``rows``: (doc_id, text, lang)."""
    least = {}
    for doc, text, _ in rows:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    fails, parts = defaultdict(list), set()
    for doc, text, lang in rows:
        text, words = text or "", re.findall(r"[^\x20\x09-\x0D]+", text or "")
        own = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words)) + "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text))
        own += "D" * bool(re.search(r"[#$%&*|]", text)) + "E" * (doc is not None and doc > least[text])
        fails[lang or ""].append((set(own), doc in good, doc in toxic))
        parts.add(lang or "")
    out = []
    for part in parts:
        shapley, steps = Counter(), []
        for order in permutations("ABCDE"):
            gone = set()
            for k, f in enumerate(order):
                here = [x for x in fails[part] if f in x[0]]
                removed = [x for x in here if not x[0] & gone]
                gone.add(f)
                kept = sum(not x[0] & gone for x in fails[part])
                shapley[f] += len(removed)
                steps.append((part, "".join(order), k + 1, kept, len(removed), len(here) - len(removed), sum(x[0] == {f} for x in here), sum(x[1] for x in removed), sum(x[2] for x in removed), f))
        out += [(*x[:-1], shapley[x[-1]]) for x in steps]
    return sorted(out)


def test_audit_equals_brute_force(spark, texts, monkeypatch):
    r = random.Random(3)
    monkeypatch.setattr(audit, "RANGE", 3)
    monkeypatch.setattr(audit, "STEP", 2)
    more = [" ".join(r.choice(("Word", "other", "x#y", "plain", f"w{k}", f"v{k}")) for k in range(r.choice((10, 250, 400)))) for _ in range(60)]
    every = [*texts, *more, *more[:20]]
    langs = [r.choice(("en", "de", None, "")) for _ in every]
    docs = frame_of(spark, every, langs)
    docs = docs.union(docs.where("doc_id < 3")).union(docs.where("doc_id = 2").selectExpr("CAST(NULL AS bigint)", *docs.columns[1:]))
    rows = [(x["doc_id"], x["text"], x["lang"]) for x in docs.collect()]
    marks = [(i, r.choice((0, 1, None)), r.choice((0, 1, None)), "x", 5) for i in range(0, 140, 2)] + [(2, 0, 1, "x", 5), (None, 1, 1, "x", 5), (999, 1, 1, "x", 5)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int, row string, mask int")
    good, toxic = {m[0] for m in marks if m[1] == 1} - {None}, {m[0] for m in marks if m[2] == 1} - {None}
    found = audit.audit(docs, labels)
    assert sorted(tuple(x) for x in found.collect()) == plain_audit(rows, good, toxic)
    assert audit.audit(docs.limit(0), labels).count() == 0
    assert audit.audit(docs.limit(1), labels.limit(0)).count() == 600


def test_galloping(monkeypatch):
    r = random.Random(8)
    for _ in range(200):
        monkeypatch.setattr(audit, "STEP", r.choice((1, 3, 256)))
        a, b, c = (np.array(sorted(r.sample(range(300), r.randrange(120))), dtype=np.int64) for _ in range(3))
        assert audit.held(a, b).tolist() == [x in set(b.tolist()) for x in a.tolist()]
        assert audit.union([a, b, c]).tolist() == sorted({*a.tolist(), *b.tolist(), *c.tolist()})
