"""All stages of the corpus pipeline in order, each against a plain version on its own input."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from fluxwell.llm import mixing, pii, rules, tokens
from fluxwell.llm.common import settle
from fluxwell.llm.queries import TARGETS, labelled_domains

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """The given documents, with near copies, personal data, and texts that base rules reject put among them."""
    folder, r = str(tmp_path_factory.mktemp("corpus")), random.Random(7)
    given = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = given.columns, [tuple(x) for x in given.collect()]
    at = {c: i for i, c in enumerate(columns)}
    top = max(x[at["doc_id"]] for x in rows) + 1
    long = [x for x in rows if len((x[at["text"]] or "").split()) > 100]

    def planted(source, text):
        nonlocal top
        out = list(source)
        out[at["doc_id"]], out[at["text"]], out[at["n_chars"]] = top, text, len(text)
        rows.append(tuple(out))
        top += 1

    for source in long[:15]:
        words = source[at["text"]].split(" ")
        words[r.randrange(len(words))] = "changed"
        planted(source, " ".join(words))
        planted(source, source[at["text"]].upper())
    for k, source in enumerate(long[15:25]):
        planted(source, f"{source[at['text']]} write to user{k}@example.org or 10.0.0.{k} now, {source[at['text']][::-1]}")
    planted(long[0], "same three words " * 60)
    planted(long[0], "short")
    spark.createDataFrame(rows, given.schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input and result of each stage."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        done = settle(stage(spark, docs, sf_dir), "stage")
        out[name] = docs, done
        docs = done
    return out


def texts_of(frame):
    return {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}


def test_order_and_columns(spark, stages, sf_dir):
    assert list(stages) == ["quality rules", "SimHash near-dedup", "personal data", "soft mixing", "best-fit packing"]
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert all(done.columns == columns for _, done in list(stages.values())[:-1])


def test_quality_stage(spark, stages, sf_dir):
    docs, done = stages["quality rules"]
    kept, failed = set(texts_of(done)), set()
    for i, text in texts_of(docs).items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        times, covered = Counter(zip(words, words[1:], words[2:])), set()
        for k, w in enumerate(zip(words, words[1:], words[2:])):
            covered |= {k, k + 1, k + 2} if times[w] > 1 else set()
        if len(words) < 50 or 100 * len(covered) > 50 * len(words):
            failed.add(i)
    assert len(failed) >= 2 and not kept & failed
    judged = rules.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert kept == {r["doc_id"] for r in judged.where("kept").collect()}
    assert len(kept) > 0.8 * (docs.count() - len(failed))


def test_near_dedup_stage(stages):
    docs, done = stages["SimHash near-dedup"]
    texts = texts_of(docs)
    grams = {}
    for i, text in texts.items():
        words = (text or "").encode().lower().split()
        grams[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    ids, root = sorted(texts), {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(grams[i] & grams[j])
            if both and both >= 0.8 * len(grams[i] | grams[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    expected = {find(i) for i in ids}
    assert texts_of(done) == {i: texts[i] for i in expected} and len(expected) <= len(ids) - 20


def test_personal_data_stage(stages):
    docs, done = stages["personal data"]
    spans = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
    before, after, changed = texts_of(docs), texts_of(done), 0
    assert before.keys() == after.keys()
    for i, text in before.items():
        out, at, islands = "", 0, []
        for s in spans[i]:
            if islands and s["start"] < islands[-1][1]:
                islands[-1][1] = max(islands[-1][1], s["end"])
            else:
                islands.append([s["start"], s["end"], s["kind"].upper()])
        for start, end, kind in islands:
            out, at = out + text[at:start] + f"[{kind}]", end
        assert after[i] == (out + text[at:] if islands else text), i
        changed += bool(islands)
    assert changed >= 10 and not any(re.search(r"user\d+@example\.org|10\.0\.0\.\d", t) for t in after.values())
    assert all(r["n_chars"] == len(r["text"]) for r in done.collect())


def test_mixing_stage(spark, stages, sf_dir):
    docs, done = stages["soft mixing"]
    known = labelled_domains(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    wanted = {r["doc_id"]: r["copies"] for r in mixing.mix(docs, known, TARGETS).collect()}
    assert Counter(r["doc_id"] for r in done.collect()) == Counter({i: n for i, n in wanted.items() if n})
    assert min(wanted.values()) >= 1
    texts = texts_of(docs)
    assert all(r["text"] == texts[r["doc_id"]] for r in done.collect())


def test_packing_stage(stages):
    docs, done = stages["best-fit packing"]
    tokenizer = Tokenizer.from_file(tokens.vocabulary())
    wanted, total = Counter(), 0
    for r in docs.select("doc_id", "text").collect():
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 2]
        total += len(ids)
        first = len(ids) % 1024 or 1024
        for piece, (a, b) in enumerate(zip([0, *range(first, len(ids), 1024)], range(first, len(ids) + 1, 1024))):
            wanted[r["doc_id"], piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    rows, sequences = done.collect(), defaultdict(list)
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == wanted
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(parts, parts[1:])) and sum(parts[-1]) <= 1024
    assert len(sequences) <= 1.03 * total / 1024 + 2


def test_run_equals_its_stages(spark, stages, sf_dir):
    key = lambda frame: Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in frame.collect())
    assert key(corpus_pipeline.run(spark, sf_dir)) == key(stages["best-fit packing"][1])


def test_stages_take_an_empty_table(spark, sf_dir, tmp_path):
    none = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
