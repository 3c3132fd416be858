from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from foyer.llm import bpe, secrets, toxicity
from foyer.llm.common import table
from foyer.llm.queries import ORACLE_SQL, PATTERN, QUERIES, RANKS, TARGETS
from helpers import near_components
from pyspark.sql import functions as F
from test_vectors_and_mix import poisson

FOLDER = "/root/testdata/sf0.001"


def values(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, key):
    found = QUERIES[key](spark, FOLDER)
    columns = sorted(found.columns)
    with duckdb.connect() as con:
        for name in ("documents", "embeddings", "pages", "labels"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
        expected = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[key]})").fetchall()
    assert values(tuple(r) for r in found.select(*columns).collect()) == values(expected)


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_bpe_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    coder = bpe.encoding(RANKS, PATTERN)
    for r in QUERIES["op1_byte_bpe"](spark, FOLDER).collect():
        ids = coder.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_near_dedup_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    found = QUERIES["op3_minhash_near_dedup"](spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == near_components(rows)


def test_pipeline_equals_brute_force(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    model = toxicity.fit(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    left = {i: r for i, r in docs.items() if model.score(r.text) < 0.5}
    assert 0 < len(left) < len(docs)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    fold = str.maketrans(upper, upper.lower())
    last = {(left[i].text or "").translate(fold): i for i in sorted(left)}
    left = {i: left[i] for i in last.values()}
    parts = near_components([(i, r.text) for i, r in left.items()])
    left = {i: r for i, r in left.items() if parts[i][1] == i}
    size = {}
    for r in left.values():
        key = r.source if r.source in TARGETS else None
        size[key] = size.get(key, 0) + len(r.text or "")
    share = {s: w for s, w in TARGETS.items() if size.get(s)} | {None: 1 - sum(TARGETS.values())}
    rate = {s: w / sum(share.values()) * sum(size.values()) / size[s] for s, w in share.items()}
    coder, expected = bpe.encoding(RANKS, PATTERN), []
    for i, r in left.items():
        u = int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) / 2**52
        ids = coder.encode_ordinary(r.text or "")
        expected += [(i, r.source, ids, len(ids), len((r.text or "").encode()))] * poisson(u, rate.get(r.source, rate[None]))
    found = corpus_pipeline.run(spark, FOLDER)
    assert values(tuple(r) for r in found.collect()) == values(expected)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), FOLDER).dtypes == docs.dtypes, name
        odd = docs.limit(5).select([F.lit(None).cast(t).alias(c) for c, t in docs.dtypes])
        assert stage(spark, odd, FOLDER).count() <= 5
        assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_pipeline_hands_on_written_stages(spark, monkeypatch):
    handed = []
    note = lambda s, docs, folder: handed.append(docs.inputFiles()) or docs.where("doc_id % 2 = 0")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", note), ("two", note)])
    found = corpus_pipeline.run(spark, FOLDER)
    assert FOLDER in handed[0][0] and not any(FOLDER in f for f in [*handed[1], *found.inputFiles()])
    assert found.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id % 2 = 0").count()


def documents_of(spark, folder=FOLDER):
    return spark.read.parquet(f"{folder}/documents.parquet").collect()


def in_fold(key, folds, wanted):
    return zlib.crc32(str(key).encode()) % folds == wanted


def plain_grams(text):
    """Counts of 1- to 3-grams of letters and word edges, under their numbers."""
    padded = [c if c.isalpha() else "\1" for c in f" {text.lower()}  "]
    out = Counter()
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        for gram, counts in ((b, b != "\1"), (a + b, a != "\1" or b != "\1"), (a + b + c, b != "\1")):
            if counts:
                out[sum(ord(x) << 21 * (len(gram) - 1 - n) for n, x in enumerate(gram))] += 1
    return out


def plain_profile(counts, top=400):
    return sorted(counts, key=lambda g: (-counts[g], g))[:top]


def test_language_query_equals_brute_force(spark):
    docs = documents_of(spark)
    learned = {}
    for r in docs:
        if r.lang is not None and r.text is not None and not in_fold(r.doc_id, 4, 2):
            learned.setdefault(r.lang, Counter()).update(plain_grams(r.text))
    known = {lang: {g: n for n, g in enumerate(plain_profile(c))} for lang, c in learned.items()}
    found = {r.doc_id: r for r in QUERIES["op9_language_id"](spark, FOLDER).collect()}
    assert len(found) == len(docs)
    for r in docs:
        own = plain_profile(plain_grams(r.text or ""))
        want = ("und", 0.0)
        if own:
            far = {lang: sum(min(abs(n - p[g]), 400) if g in p else 400 for n, g in enumerate(own)) for lang, p in known.items()}
            least = min(sorted(far), key=lambda lang: far[lang])
            want = (least, 1 - far[least] / (400 * len(own)))
        assert found[r.doc_id].lang_pred == want[0] and abs(found[r.doc_id].score - want[1]) < 1e-12
        assert found[r.doc_id].held_out == in_fold(r.doc_id, 4, 2)


def test_toxicity_query_equals_brute_force(spark):
    """The scores of the whole query by a plain sum over the fitted weights, and what the fit may have seen."""
    docs, labels = table(spark, FOLDER, "documents").select("doc_id", "text"), table(spark, FOLDER, "labels")
    seen = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    model = toxicity.fit(docs, seen)
    found = {r.doc_id: r for r in QUERIES["op10_toxicity"](spark, FOLDER).collect()}
    for r in documents_of(spark):
        words = set(re.findall(r"[^\W\d_]+", (r.text or "").lower()))
        features = {f"{w}$" for w in words} | {w[:n] for w in words for n in (3, 4, 5, 6) if len(w) >= n}
        numbers = {zlib.crc32(f.encode()) % toxicity.NUMBERS for f in features}
        score = 1 / (1 + math.exp(-(model.bias + math.fsum(model.weights[n] for n in numbers))))
        assert abs(found[r.doc_id].score - score) < 1e-9 and found[r.doc_id].held_out == in_fold(r.doc_id, 5, 0)
        assert found[r.doc_id].predicted == int(found[r.doc_id].score >= 0.5)


def test_secret_query_equals_brute_force(spark):
    """The spans of the patterns and of the models over whole texts."""
    docs = table(spark, FOLDER, "documents").select("doc_id", "text")
    ratios = secrets.train(secrets.samples(docs))
    size, number = len(secrets.SYMBOLS) + 1, {c: n + 1 for n, c in enumerate(secrets.SYMBOLS)}
    kinds = [
        (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
        (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
        (re.compile(r"[0-9a-f]+"), 0, 32),
    ]
    found = {r.doc_id: r.spans for r in QUERIES["op5_secret_scan"](spark, FOLDER).collect()}
    for r in documents_of(spark):
        text = r.text or ""
        base = [(m.start(), k, m.end()) for k, (p, g, n) in enumerate(kinds) for m in p.finditer(text) if len(m[g]) >= n]
        spans = list(base)
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
            codes = [0, *[number[c] for c in m[0]]]
            ratio = sum(ratios[a * size + b] for a, b in zip(codes, codes[1:]))
            if ratio >= max(20, 0.7 * len(m[0])) and not any(a < m.end() and m.start() < b for a, _, b in base):
                spans.append((m.start(), 3, m.end()))
        assert found[r.doc_id] == ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
    assert found
