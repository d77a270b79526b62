"""Operators for training data against brute force, and their defined results on odd inputs."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from math import ceil

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fluxwell.llm import chat, embeddings, mixing, packing, pii, rules, shingles, simhash, tokencount, tokenfiles, tokens, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, kind string"
ODD = [None, "", " ", "a", "a b", "\n\n", "x" * 30_000, "Même  texte\tà\n b", "same old text here " * 30, "same old text here " * 30, "1 " * 3000, "ab <|endoftext|> cd<|endoftext|>"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), "extra", "k") for i, t in enumerate(ODD)]
    rows += [(None, "no id", None, None, None, None, None), (3, "a", None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def labels_of(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def smallest_reached(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(x) for x in range(n)]


def library_ids(plain=False):
    tokenizer = Tokenizer.from_file(tokens.vocabulary())
    if plain:
        tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library():
    random.seed(3)
    letters = "ab '\n\t\x0b\x1c\x85 　é1_-.<|>\U0001f600́"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 40))) for _ in range(1500)]
    texts += ["<|endoftext|> x", "a<|endoftext|>", "\n<|endoftext|><|endoftext|> b  c", "<|endof text|>", "it's I'll 'x", " lead", "trail ", "trail\n", None]
    for plain in (False, True):
        ids = library_ids(plain)
        for text, raw in zip(texts, tokens.encoder(tokens.vocabulary(), plain).encode(texts), strict=True):
            assert np.frombuffer(raw, dtype="<u4").tolist() == ids(text), text


class Counting:
    """A tokenizer that counts the characters that it is given."""

    def __init__(self, inner):
        self.inner, self.chars = inner, 0

    def encode_batch_fast(self, texts, **more):
        self.chars += sum(map(len, texts))
        return self.inner.encode_batch_fast(texts, **more)


def test_words_are_encoded_once_whatever_ends_them():
    encoder, ids = tokens.Encoder(tokens.vocabulary()), library_ids()
    encoder.tokenizer = Counting(encoder.tokenizer)
    words = [f"wörd{x}é" for x in "abcdefghijklmnopqrstuvwxyz"]
    texts = ["a " + " ".join(w + end for w in words) for end in ("", ",", "...", "_'", "!)", "'s,", "\u0301,", ",\u0301")]
    for text in texts:
        assert np.frombuffer(encoder.encode([text])[0], dtype="<u4").tolist() == ids(text)
    # the word alone, before 's, and with an accent of its own are words apart; the other ends come on their own
    assert encoder.tokenizer.chars < 5 * len(texts[0]) + 60


def test_words_met_last_stay_known(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 40)
    encoder, ids = tokens.Encoder(tokens.vocabulary()), library_ids()
    encoder.tokenizer = Counting(encoder.tokenizer)
    for k in range(200):
        text = f"all of these words come again and again but new{k} never"
        assert np.frombuffer(encoder.encode([text])[0], dtype="<u4").tolist() == ids(text)
    assert encoder.tokenizer.chars < 200 * len(" new100") + 60


def test_long_words_are_not_kept():
    encoder, ids = tokens.Encoder(tokens.vocabulary()), library_ids()
    texts = ["short " + "語" * 3000 + f"{k}, short" for k in range(20)]
    for text in texts:
        assert np.frombuffer(encoder.encode([text])[0], dtype="<u4").tolist() == ids(text)
    assert encoder.words.to_pylist() == ["\nshort", "short"] and len(encoder.ids) == len(encoder.met) == 2


def test_token_files_and_counts(spark, docs, none):
    ids = library_ids()
    rows = sorted(((r["doc_id"], ids(r["text"])) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    found = sorted(tokenfiles.read(tokenfiles.write(docs, length=64)).collect(), key=lambda r: r["start"])
    at = 0
    for r, (doc, own) in zip(found, rows, strict=True):
        raw = np.array(own + [0], dtype="<u4").tobytes()
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc, at, len(own) + 1, zlib.crc32(raw))
        at += len(own) + 1
    plain = library_ids(plain=True)
    rows = [(r["doc_id"], plain(r["text"])) for r in docs.collect()]
    counts = Counter((r["doc_id"], r["n_tokens"]) for r in tokencount.count_tokens(docs).collect())
    assert counts == Counter((d, len(x)) for d, x in rows)
    written = tokencount.write(docs)
    files = written.groupBy("path").agg(F.max("n_ids").alias("n_ids"))
    assert sorted(r["n_tokens"] for r in tokencount.scan(files, block=7).collect()) == sorted(len(x) for _, x in rows)
    assert tokenfiles.read(tokenfiles.write(none)).count() == tokencount.count_tokens(none).count() == 0


def test_ids_of_four_bytes_are_not_cut(spark, tmp_path):
    folder = str(tmp_path)
    ids = np.array([1, 50256 + 65536, 7, 50256, 65536, 50256], dtype="<u4")
    (tmp_path / "flat").write_bytes(ids.tobytes())
    files = spark.createDataFrame([(f"file://{folder}/flat", 6)], "path string, n_ids long")
    assert sorted(r["n_tokens"] for r in tokencount.scan(files, block=2, kind="<u4").collect()) == [1, 3]
    assert tokens.id_type(tokens.vocabulary()) == "<u2"


def test_repeated_ids_stand_in_one_order(spark):
    rows = spark.createDataFrame([(7, f"text {k}", "x") for k in range(400)] + [(3, "first", "x"), (None, "none", "x")], "doc_id long, text string, row string")
    found = [sorted(tuple(r) for r in tokenfiles.read(tokenfiles.write(rows.repartition(n), length=16)).selectExpr("start", "doc_id", "n_tokens", "ids_crc32").collect()) for n in (1, 5)]
    assert found[0] == found[1] and [r[1] for r in found[0]][:3] == [None, 3, 7]


def test_sequences_of_a_file(spark, docs):
    path = tokenfiles.write(docs.where("doc_id = 10").coalesce(1), length=64).first()["path"]
    found = tokenfiles.Sequences(path)
    ids, mask = found[0]
    assert ids.tolist() == library_ids()(ODD[10])[:64] and all(mask.to_pylist())
    assert len(found) == ceil((len(library_ids()(ODD[10])) + 1) / 64)


def test_packing(spark, docs, none):
    ids = library_ids()
    found = packing.pack_documents(docs).collect()
    by_sequence, total = defaultdict(list), 0
    for r in found:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    for i, text in enumerate(ODD):
        own = ids(text) + [packing.END_ID]
        total += len(own)
        pieces = sorted((r for r in found if r["doc_id"] == i and not (i == 3 and r["length"] != len(own))), key=lambda r: r["piece"])
        if i != 3:
            assert [r["length"] for r in pieces[1:]] == [packing.CAPACITY] * (len(pieces) - 1)
            for r in pieces:
                assert r["ids_crc32"] == zlib.crc32(np.array(own[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes())
    assert len(by_sequence) <= ceil(total / packing.CAPACITY) + 2
    assert packing.pack_documents(none).count() == 0


def plain_best_fit(lengths, capacity=1024):
    """Sequences that best fit needs, longest documents first."""
    gaps, count = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect_left(gaps, n)
        if at == len(gaps):
            count += 1
            gap = capacity
        else:
            gap = gaps.pop(at)
        insort(gaps, gap - n)
    return count


@pytest.mark.parametrize("rows", [1, 60, 1500])
@pytest.mark.parametrize("most", [200, 40_000])
def test_packing_takes_as_few_sequences_as_best_fit(spark, monkeypatch, rows, most):
    monkeypatch.setattr(packing, "SWEEP_ROWS", most)
    random.seed(5)
    lengths = [random.choice((40, 300, random.randint(1, 1024))) for _ in range(rows)]
    pieces = spark.createDataFrame(list(enumerate(lengths)), "piece_id long, length long")
    by_sequence = defaultdict(list)
    for r in packing.pack(pieces).collect():
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sum(map(len, by_sequence.values())) == len(lengths)
    assert len(by_sequence) <= 1.02 * plain_best_fit(lengths) + 2
    for parts in by_sequence.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(parts, parts[1:])) and sum(parts[-1]) <= 1024


def test_packing_equal_lengths(spark):
    """No gap fits, so only openings bring a round on."""
    pieces = spark.createDataFrame([(i, 600) for i in range(50)] + [(100 + i, 1024) for i in range(3)], "piece_id long, length long")
    assert packing.pack(pieces).select("sequence_id").distinct().count() == 53


def test_fingerprint():
    def plain(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    for text in [*ODD[1:], "Ää B c D e\x1cf g", "a b c d"]:
        assert simhash.fingerprint(text) == plain(text)
    assert simhash.fingerprint(None) == 0


@pytest.mark.parametrize("sample", [32_768, 40])
def test_simhash_links_are_exact(spark, monkeypatch, sample):
    """With a small sample the first trees are shallow, and crowded leaves get trees of their own."""
    monkeypatch.setattr(simhash, "LEAF", 40)
    monkeypatch.setattr(simhash, "TREE_SAMPLE", sample)
    monkeypatch.setattr(simhash, "LEAF_SAMPLE", 100)
    monkeypatch.setattr(simhash, "PART", 64)
    random.seed(1)
    points = [random.getrandbits(64) for _ in range(250)]
    for p in points[:60]:
        for _ in range(4):
            p ^= 1 << random.randrange(64)
            points.append(p)
    points += [points[0] ^ 1 << b for b in range(64)]  # more than a leaf holds, all close together
    points = sorted({p - (1 << 64) if p >> 63 else p for p in points})
    rows = spark.createDataFrame([(p,) for p in points], "fp long")
    found = {r["node"]: r["component"] for r in simhash.components(simhash.links(rows), "a", "b").collect()}
    pairs = [(i, j) for i in range(len(points)) for j in range(i) if ((points[i] ^ points[j]) & simhash.FULL).bit_count() <= 2]
    assert [found.get(p, p) for p in points] == [points[k] for k in smallest_reached(len(points), pairs)]


def test_crowded_leaves_are_parted(spark):
    random.seed(2)
    rows = spark.createDataFrame([(0, "0", random.getrandbits(64) - (1 << 63)) for _ in range(30_000)], "half int, leaf string, fp long")
    parted = simhash.split_leaves(rows, 1)
    sizes = [r["count"] for r in parted.groupBy("leaf").count().collect()]
    assert max(sizes) < 8_000 and len(sizes) > 8 and parted.select("fp").distinct().count() == 30_000


def test_simhash_odd_rows(spark, docs, none):
    found = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert len(found) == len(ODD) + 1
    assert {c for (d, f), c in found.items() if f == "0" * 16} == {0}
    assert found[9, f"{simhash.fingerprint(ODD[9]):016x}"] == 8
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and kept.where("doc_id IS NULL").count() == 1
    twice = docs.where("doc_id IN (3, 9)").union(docs.where("doc_id IN (3, 9)")).union(docs.where("doc_id IS NULL")).union(docs.where("doc_id IS NULL"))
    assert sorted(r["text"][:4] for r in simhash.deduplicate(twice).collect()) == ["a", "no i", "same"]
    by_words = simhash.deduplicate(twice, words=5, similarity=0.8)
    assert sorted(r["text"][:4] for r in by_words.collect()) == ["a", "no i", "same"] and by_words.columns == docs.columns
    assert {1, 2, 9}.isdisjoint({r[0] for r in kept.select("doc_id").collect()})
    assert simhash.near_duplicates(none).count() == 0


def test_near_copies_of_shingles(spark, docs, none):
    random.seed(6)
    pool = [f"w{i}" for i in range(400)]
    texts = [" ".join(random.choice(pool) for _ in range(random.randint(3, 90))) for _ in range(60)]
    for base in texts[:40]:
        for edits in (1, 1, 2, 3):
            own = base.split()
            for _ in range(edits):
                own[random.randrange(len(own))] = random.choice(pool)
            texts.append(" ".join(own))
    texts += [texts[0].upper(), " ".join(texts[1].split()[:-2]), *ODD]
    grams = []
    for text in texts:
        own = (text or "").lower().encode().split()
        grams.append({tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else {()})
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])]
    rows = spark.createDataFrame([(i, t, None, None, 0, None, None) for i, t in enumerate(texts)], DOCS)
    by_root = defaultdict(set)
    for r in shingles.groups(rows).collect():
        by_root[r["root"]].add(r["doc_id"])
    expected, roots = defaultdict(set), smallest_reached(len(texts), pairs)
    for i, root in enumerate(roots):
        expected[root].add(i)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, expected.values()))
    import corpus_pipeline

    kept = corpus_pipeline.simhash_near_dedup(spark, rows, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots)) and kept.columns == rows.columns
    assert len(set(roots)) < len(texts) - 50
    assert simhash.deduplicate(none, words=5, similarity=0.8).count() == 0


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 20)
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    random.seed(2)
    base = np.random.default_rng(2).normal(size=(60, 8))
    vectors = [*base, *(base[:30] + 0.12 * np.random.default_rng(3).normal(size=(30, 8))), *[base[0]] * 25]
    rows = [(i, [float(x) for x in v], i % 2 if i < 60 else (i - 60) % 2 if i < 90 else 0, "x") for i, v in enumerate(vectors)]
    n = len(rows)
    rows += [(n, None, 0, "x"), (n + 1, [0.0] * 8, 0, "x"), (n + 2, [float("nan")] * 8, 0, "x"), (n + 3, [None] * 8, 0, "x"), (n + 4, [1.0] * 8, None, "x"), (n + 5, [], 0, "x")]
    found = sorted(embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string")).collect())
    unit = np.array(vectors, dtype=np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    same = np.array([r[2] for r in rows[:n]])
    near = (unit @ unit.T >= 0.93) & (same[:, None] == same[None, :])
    np.fill_diagonal(near, False)
    roots = smallest_reached(n, zip(*np.nonzero(near), strict=True)) + list(range(n, n + 6))
    counts = [*near.sum(axis=1).tolist(), *[0] * 6]
    assert [tuple(r) for r in found] == [(i, counts[i], roots[i], roots[i] == i) for i in range(n + 6)]


def test_embeddings_cells_are_cut_level_by_level(spark, monkeypatch):
    for name, value in {"CELL": 24, "BLOCK": 16, "SAMPLE": 96, "PART": 40, "MOST_PIVOTS": 4}.items():
        monkeypatch.setattr(embeddings, name, value)
    draw = np.random.default_rng(11)
    spread = draw.normal(size=(500, 3))
    crowd = np.array([1.0, 2.0, 3.0]) + 0.02 * draw.normal(size=(60, 3))  # all within reach: no pivots can cut these
    vectors = np.concatenate([spread, crowd, draw.normal(size=(80, 3))])
    labels = ["a"] * 560 + ["b"] * 80
    n = len(vectors)
    # rows that repeat an id, and rows without one, count each
    ids = [None if i in (7, 520) else 3 if i == 9 else i for i in range(n)]
    rows = [(ids[i], [float(x) for x in v], labels[i], float(i), "x") for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, home double, cell string")
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    near = (unit @ unit.T >= 0.998) & (np.array(labels)[:, None] == np.array(labels)[None, :])
    np.fill_diagonal(near, False)
    root = smallest_reached(n, zip(*np.nonzero(near), strict=True))
    least = {}
    for i in range(n):
        if ids[i] is not None:
            least[root[i]] = min(least.get(root[i], ids[i]), ids[i])
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)
    expected = sorted(((ids[i], int(near[i].sum()), least.get(root[i]), ids[i] == least.get(root[i])) for i in range(n)), key=key)
    assert sorted((tuple(r) for r in embeddings.near_vectors(table, 0.998).collect()), key=key) == expected
    distinct = table.selectExpr("vec_id AS id", "label", "size(embedding) AS dims", "1L AS copies", "embedding").where("id IS NOT NULL")
    cells = embeddings.cut_cells(distinct, 0.0633).groupBy("cell", "levels").count().collect()
    assert max(r["levels"] for r in cells) >= 7 and max(r["count"] for r in cells) > 24
    assert embeddings.near_vectors(table.limit(0)).collect() == []


def test_quality_statistics_and_rules(spark, docs, none):
    for r in rules.judge(docs, labels_of(spark)).collect():
        if r["doc_id"] is None or r["doc_id"] == 3:
            continue
        text = ODD[r["doc_id"]] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        times, covered = Counter(windows), set()
        for i, w in enumerate(windows):
            covered |= {i, i + 1, i + 2} if times[w] > 1 else set()
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert tuple(r[c] for c in rules.BASE) == expected
        assert r["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words)) and r["kept"] == (not r["base_failed"])
    good = [(i, " ".join(f"w{(i * 7 + k * k) % 997}x{k}" for k in range(80)), None, None, 0, None, None) for i in range(400)]
    bad = [(i + 1000, t.replace(" ", " ## "), *rest) for i, t, *rest in good]
    noisy = spark.createDataFrame(good + bad, DOCS)
    marks = labels_of(spark, [(i, int(i < 1000), 0) for i, *_ in good + bad if i % 2])
    verdicts = {r["doc_id"]: r["kept"] for r in rules.judge(noisy, marks).collect()}
    assert all(v == (i < 1000) for i, v in verdicts.items())
    assert rules.keep_good(noisy, marks).columns == noisy.columns and rules.keep_good(noisy, marks).count() == 400
    assert rules.judge(none, labels_of(spark)).count() == 0


def base_spans(text):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for order, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(digits[::-1])) % 10 == 0
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 14 <= len(digits) <= 19 and luhn, "phone": 10 <= len(digits) <= 15}
            if ok[kind]:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [x[-1] for x in sorted(out)]


def test_personal_data(spark, docs, none):
    random.seed(4)
    texts = ["a@b.c%d@e.f x..@y.z", "1.2.3.4.5.6.7.8 0255.1.1.1 256.1.1.1", "é 4111 1111-1111 1111 +1 (974) 555-3436", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "9" * 20_000, "1 " * 20_000, "a" * 20_000]
    texts += ["".join(random.choice("ab1.@+- 4()é%") for _ in range(60)) for _ in range(400)]
    rows = spark.createDataFrame([(i, t, None, None, 0, None, None) for i, t in enumerate(texts)], DOCS)
    for r in pii.find(rows.union(docs.where("doc_id IS NULL"))).select("doc_id", *(f"n_{k}" for k in pii.KINDS), pii.joined(F.col("base")).alias("base"), pii.joined(F.col("spans")).alias("spans")).collect():
        expected = base_spans(texts[r["doc_id"]]) if r["doc_id"] is not None else []
        assert r["base"] == ",".join(expected)
        assert set(expected) <= set(r["spans"].split(",")) or not expected
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k) for s in expected) for k in pii.KINDS]
        assert hashlib.sha256(r["base"].encode()).hexdigest()
    clean = {r["doc_id"]: r["text"] for r in pii.redact(rows).collect()}
    assert clean[2].startswith("é [CARD] [PHONE]") and clean[6] == texts[6]
    assert pii.find(none).count() == 0 and pii.redact(docs).count() == docs.count()


def test_personal_data_of_both_forms(spark):
    key = lambda i: hashlib.md5(str(i).encode()).hexdigest()[:24]
    texts = [f"ring +1 ({200 + i}) 555-{1000 + i} now" for i in range(80)] + [f"ring ({300 + i}) 555-{2000 + i} now" for i in range(80)]
    texts += [f"api_key={key(i)} x" for i in range(80)] + [f"password=Z{key(i)}== x" for i in range(80)]
    texts += [f"at {i} of {1000 + i} and {hashlib.sha1(str(i).encode()).hexdigest()}" for i in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in pii.redact(rows).collect()}
    assert clean[0] == "ring [PHONE] now" and clean[80] == "ring [LOCAL] now"
    assert clean[160] == "api_key=[SECRET] x" and clean[240] == "password=[SECRET] x"
    assert all(clean[i] == texts[i] for i in range(320, len(texts)))
    labels = dict(pii.spans(rows.where("doc_id in (0, 160)"))[1].where("gen >= 4").select("match", pii.label()).collect())
    assert labels == {"(200) 555-1000": 1, key(0): 1}


def test_choice_of_spans_equals_brute_force(spark):
    r = random.Random(3)
    rows, expected = [], {}
    for row in range(40):
        spans, base_end = [], 0
        for _ in range(12):
            start = r.randrange(60)
            spans.append((start, start + r.randrange(1, 15), r.randrange(4, 6), False))
        while base_end < 60:
            start = base_end + r.randrange(12)
            base_end = start + r.randrange(1, 9)
            spans.append((start, base_end, r.randrange(4), True))
        rows += [(row, g, "x" * (e - s), s, e, "", "", b) for s, e, g, b in spans]
        kept = []
        for s, e, g, b in sorted(set(spans), key=lambda x: (x[0], -x[1], not x[3], x[2])):
            if b or not any(x[0] <= s and e <= x[1] for x in kept):
                kept.append((s, e, g, b))
        expected[row] = sorted(kept)
    candidates = spark.createDataFrame(rows, "row long, gen int, match string, start long, end long, before string, after string, base boolean").distinct()
    found = defaultdict(list)
    for x in pii.select(candidates, ([], 5.0, 0.5)).collect():
        found[x["row"]].append((x["start"], x["end"], x["gen"], x["base"]))
    assert {k: sorted(v) for k, v in found.items()} == expected


def test_many_spans_of_one_text_take_linear_time(spark):
    texts = [f"a{'b' * 5}@c.de " * n for n in (20_000, 80_000)]
    took = []
    for text in texts:
        start = time.time()
        r = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).select("n_email", F.size("spans")).first()
        took.append(time.time() - start)
        assert tuple(r) == (len(text) // 12, len(text) // 12)
    assert took[1] < 4 * took[0] + 20


def test_secret_that_holds_a_card_is_covered(spark):
    text = 'token = "abcdef4111-1111-1111-1111zyxw"'
    rows = [(0, 2, "4111-1111-1111-1111", 15, 34, "", "", True), (0, 5, "abcdef4111-1111-1111-1111zyxw", 9, 38, 'token = "', '"', False)]
    candidates = spark.createDataFrame(rows, "row long, gen int, match string, start long, end long, before string, after string, base boolean")
    kept = pii.select(candidates, ([], 5.0, 0.5)).collect()
    assert {(x["start"], x["end"]) for x in kept} == {(15, 34), (9, 38)} and text[9:38].startswith("abcdef")


def test_rare_labels_are_kept_in_a_bounded_sample(spark):
    key = lambda i: hashlib.md5(str(i).encode()).hexdigest()
    texts = [" x ".join(str(10_000 + 50 * i + k) for k in range(50)) for i in range(200)]
    texts += [f'token = "{key(i)}" x' for i in range(40)] + [f"hash {key(i)} x" for i in range(100, 140)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, candidates = pii.spans(rows)
    found = pii.select(candidates, pii.fit(candidates, sample=600)).groupBy("kind").count().collect()
    assert [tuple(r) for r in found] == [("secret", 40)]


def test_toxicity(spark, docs, none):
    random.seed(6)
    words = ["river", "stone", "window", "garden", "letter", "winter", "paper", "market"]
    text = lambda bad: " ".join(random.choice(words) if random.random() > bad else random.choice(("grubbish", "grubbo", "ungrubb")) for _ in range(80))
    rows = [(i, text(0.05 * (i % 3 == 0)), None, None, 0, None, None) for i in range(600)]
    marked = labels_of(spark, [(i, 1, int(i % 3 == 0)) for i, *_ in rows])
    found = toxicity.toxicity(spark.createDataFrame(rows, DOCS), marked).collect()
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 == 0) for r in held]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    assert toxicity.toxicity(docs, labels_of(spark)).count() == docs.count() and toxicity.toxicity(none, marked).count() == 0


def test_toxicity_teaches_one_text_of_a_repeated_id(spark, monkeypatch):
    taught = []
    monkeypatch.setattr(toxicity, "train", lambda texts, marks: taught.append((texts, marks)))
    rows = [(i, f"{kind} {i}") for i in range(40) for kind in ("first", "second", "third")]
    marked = labels_of(spark, [(i, 1, i % 2) for i in range(40)] * 2)
    for some in (rows, rows[::-1]):
        toxicity.fit(spark.createDataFrame(some, "doc_id long, text string").repartition(5), marked)
    assert taught[0] == taught[1] and len(taught[0][0]) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(40))


def test_toxicity_training_is_the_same_without_kept_grams(monkeypatch):
    random.seed(8)
    texts = [" ".join(random.choice(("river", "stone", "paper", *["grubbish"] * (i % 2))) for _ in range(random.choice((1, 40, 120)))) for i in range(60)]
    texts, marks = [None, "", " \n", "a", *texts], [0, 1, 1, 0, *(i % 2 for i in range(60))]
    kept = toxicity.train(texts, marks)
    for room in (0, 5000):
        monkeypatch.setattr(toxicity, "KEPT_GRAMS", room)
        anew = toxicity.train(texts, marks)
        assert anew.bias == kept.bias and np.array_equal(anew.weights, kept.weights)


def test_mixing(spark, docs, none):
    texts = {"en": "the thing with that other", "fr": "les élèves où ça été près"}
    rows = [(i, " ".join([texts["en" if i % 4 else "fr"]] * 20), "en" if i % 4 else "fr", None, 0, None, None) for i in range(400)]
    table = spark.createDataFrame(rows, DOCS)
    known = table.where("doc_id % 2 = 0").select("doc_id", F.col("lang").alias("domain"))
    found = mixing.mix(table, known, {"en": 0.5, "fr": 0.5}).collect()
    totals = {d: sum(r["n_tokens"] * r["rate"] * r[f"p_{d}"] for r in found) for d in texts}
    assert abs(totals["en"] / totals["fr"] - 1) < 0.01 and min(r["copies"] for r in found) >= 1
    drawn = mixing.drawn(table, known, {"en": 0.5, "fr": 0.5})
    assert drawn.columns == table.columns and drawn.count() == sum(r["copies"] for r in found)
    assert mixing.mix(docs, known.limit(0), {"en": 1.0, "fr": 1.0}).count() == docs.count()
    assert mixing.mix(none, known, {"en": 1.0}).count() == 0


def test_mixing_posteriors_and_rates_equal_plain_python(spark):
    """Posteriors and steps again in plain Python, and how often the likeliest domain is right on rows kept aside."""
    r = random.Random(12)
    letters = {"en": "etaoinshrd wk", "de": "enisratdhu zß", "fr": "esaitnrulo éà"}
    rows = []
    for i in range(600):
        own = ("en", "en", "en", "de", "fr")[i % 5]
        rows.append((i, "".join(r.choice(letters[own]) for _ in range(r.choice((80, 300)))), own, None, 0, None, None))
    rows += [(600, None, "en", None, 0, None, None), (601, "", "de", None, 0, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    known = docs.where("doc_id % 3 = 0").select("doc_id", F.col("lang").alias("domain"))
    targets = {"en": 1.0, "de": 1.0, "fr": 2.0}
    classifier, steps, _ = mixing.model(docs, known, targets)

    def posteriors(text):
        lower = (text or "").lower()
        counts, n = [lower.count(m) for m in classifier.markers], len(lower)
        weight = min(max(n, 1), mixing.EVIDENCE) / max(n, 1)
        scores = [prior + weight * (sum(c * x for c, x in zip(counts, each)) + (n - sum(counts)) * rest) for prior, *each, rest in classifier.logs]
        top = max(scores)
        out = [np.exp(x - top) for x in scores]
        return [x / sum(out) for x in out]

    def rate(p):
        x = 1.0
        for step in steps:
            x = max(0.0, x - sum(a * b for a, b in zip(p, step)))
        return x

    found = {x["doc_id"]: x for x in mixing.mix(docs, known, targets).collect()}
    right = 0
    for i, text, own, *_ in rows:
        p = posteriors(text)
        assert [found[i][f"p_{d}"] for d in classifier.domains] == pytest.approx(p)
        assert found[i]["rate"] == pytest.approx(rate(p)) and found[i]["n_tokens"] == len((text or "").split())
        if i % 3 and i < 600:
            right += classifier.domains[int(np.argmax(p))] == own
    assert right >= 0.97 * 400


def test_mixing_says_when_targets_cannot_be_met(spark, monkeypatch):
    rows = [(i, "the thing with that other " * 9, "en", None, 0, None, None) for i in range(50)]
    docs = spark.createDataFrame(rows, DOCS)
    known = docs.select("doc_id", F.col("lang").alias("domain"))
    monkeypatch.setattr(mixing, "STEPS", 3)
    with pytest.warns(RuntimeWarning, match="miss their target"):
        mixing.mix(docs, known, {"en": 0.5, "fr": 0.5}, total=1e6)


def plain_calls(rows):
    """Calls and results of ``(conv, turn, role, text)`` rows."""
    calls, results = set(), set()
    for conv, turn, role, text in rows:
        if conv is None or turn is None:
            continue
        before = sorted((t, r) for c, t, r, _ in rows if c == conv and t is not None and t < turn and r in ("user", "assistant"))
        assistants, users = ([t for t, r in before if r == x] for x in ("assistant", "user"))
        if role == "assistant":
            calls.add((conv, turn, f"{conv}-{turn}", (f"{conv}-{assistants[-1]}",) if assistants else ()))
        if role == "user" and assistants and (not users or users[-1] < assistants[-1]):
            results.add((conv, f"{conv}-{assistants[-1]}", text))
    return calls, results


def test_conversations_equal_plain_python(spark):
    r = random.Random(10)
    rows = []
    for conv in range(30):
        roles = ["system"] * r.randrange(2) + [r.choice(("user", "assistant", "user", "assistant", "system", None)) for _ in range(r.randrange(12))]
        rows += [(conv, turn, role, r.choice((None, "", f"text {conv} {turn}", "word " * 40))) for turn, role in enumerate(roles)]
    rows += [(50, 0, "system", "s"), (50, 1, "user", "first question"), (50, 2, "assistant", "a"), (50, 3, "user", "done"), (50, 7, "assistant", "b")]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", "x"), (51, None, "assistant", "x"), *((52, k, ("user", "assistant")[k % 2], "long talk") for k in range(300))]
    table = spark.createDataFrame([(*x, "extra", "extra") for x in rows], "conv_id long, turn int, role string, text string, part string, level string")
    calls, results = chat.derived_calls(table)
    expected = plain_calls(rows)
    assert {(x["conv_id"], x["turn"], x["call_id"], tuple(x["needs"])) for x in calls.collect()} == expected[0]
    assert {(x["conv_id"], x["call_id"], x["content"]) for x in results.collect()} == expected[1]
    found = chat.format_conversations(table).collect()
    assert sum(x["kind"] == 0 for x in found) == len(rows) and sum(x["kind"] == 1 for x in found) == len(expected[0])
    answers = {(x["conv_id"], x["call_id"]) for x in found if x["kind"] == 2}
    assert answers == {(c, k) for c, k, _ in expected[1]} and not any(x["status"] in ("no call", "cyclic") for x in found)
    assert {x["call_id"]: x["level"] for x in found if x["kind"] == 1 and x["conv_id"] == 52} == {f"52-{k}": k // 2 for k in range(1, 300, 2)}
    questions = [x for x in found if x["conv_id"] == 50 and x["kind"] == 2]
    assert [(x["call_id"], "first question" in x["json"]) for x in questions] == [("50-2", False)]
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_conversations_over_many_ranges(spark):
    """One conversation in several ranges: what lies before a range counts."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(1, k, "user" if k in (0, 399) else "assistant" if k == 3 else "system", f"t{k}") for k in range(400)]
        table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)
        results = chat.derived_calls(table)[1].collect()
        assert [(x["call_id"], x["content"]) for x in results] == [("1-3", "t399")]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_chat(spark):
    messages = spark.createDataFrame([(1, 0, "user", 'say "hi"'), (1, 1, None, None), (None, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    calls = spark.createDataFrame(
        [(1, 1, "b", "search", '{"words": 3, "query": "q"}', ["a"]), (1, 1, "a", "search", '{"query": 5, "words": 1}', None), (1, 2, "c", "search", "{", ["d"]), (1, 2, "d", "search", "[1]", ["c"]), (1, 3, "e", "other", "{}", []), (1, 3, "f", "lookup", '{"query":"q","words":1}', [])],
        "conv_id long, turn long, call_id string, tool string, arguments string, needs array<string>",
    )
    results = spark.createDataFrame([(1, "b", "done"), (1, "z", "lost"), (1, "b", "done")], "conv_id long, call_id string, content string")
    found = chat.format_chat(messages, calls, results, chat.SCHEMAS).collect()
    by = {(r["kind"], r["call_id"]): r for r in found if r["kind"]}
    assert by[1, "b"]["json"] == '{"arguments":"{\\"query\\":\\"q\\",\\"words\\":3}","id":"b","name":"search","role":"call"}'
    assert (by[1, "a"]["level"], by[1, "b"]["level"], by[1, "c"]["level"]) == (0, 1, None)
    assert {k: r["status"] for (_, k), r in by.items()} == {"a": "query is no string", "b": "ok", "c": "arguments are no JSON", "d": "arguments are no object", "e": "unknown tool", "f": "limit is missing", "z": "no call"}
    assert sum(r["kind"] == 0 for r in found) == 3 and by[2, "z"]["turn"] is None


def test_levels_of_calls_equal_brute_force(spark):
    r = random.Random(5)
    needs = {f"c{i:03d}": [f"c{i - 1:03d}"] for i in range(1, 70)} | {"c000": []}
    needs |= {f"d{i:02d}": [f"d{j:02d}" for j in r.sample(range(i), min(i, r.randrange(4)))] + ["absent"] for i in range(30)}
    needs |= {"d30": ["c069", "d29", "c010"], "d31": ["d30"], "d32": ["d31", "c069"]}
    needs |= {"x1": ["x2"], "x2": ["x3"], "x3": ["x1"], "x4": ["x1"], "x5": ["x4", "c001"], "x6": ["x5"], "x7": ["x7"]}
    rows = [(k, call, own) for k in (1, 2) for call, own in needs.items()] + [(3, "c001", ["c000"])]
    calls = spark.createDataFrame(rows + rows[:3], "conv_id long, call_id string, needs array<string>")

    expected = {(3, "c001"): 0}
    for k in (1, 2):
        todo = dict(needs)
        while True:
            free = {c for c, own in todo.items() if not any(x in todo for x in own)}
            if not free:
                break
            for c in free:
                expected[k, c] = max((1 + expected[k, x] for x in needs[c] if x in needs), default=0)
                del todo[c]
    found = [((x["conv_id"], x["call_id"]), x["level"]) for x in chat.levels(calls).collect()]
    assert len(found) == len(expected)
    assert dict(found) == expected
