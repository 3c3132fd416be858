from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import duckdb
import pytest
from foyer.llm import mixing, topk
from foyer.llm.queries import _mix_sql
from helpers import documents
from pyspark.sql import functions as F


def best(rows, asked, k):
    """Brute force over (id, vector) rows."""
    out = []
    for q, v in asked:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize(("row_block", "query_block"), [(16_384, 256), (70, 3)])
def test_top_k_equals_brute_force(spark, monkeypatch, row_block, query_block):
    monkeypatch.setattr(topk, "ROW_BLOCK", row_block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", query_block)
    draw = random.Random(4)
    rows = [(i * 3, [draw.randint(-9, 9) for _ in range(6)]) for i in range(300)]
    rows += [(2000 + i, [1, 2, 3, -4, 5, 6]) for i in range(40)]
    asked = [r for r in rows if r[0] % 30 == 0]
    schema = "id long, vector array<long>"
    found = topk.top_k(spark.createDataFrame(rows, schema), spark.createDataFrame(asked, schema), 5)
    assert sorted(map(tuple, found.collect())) == best(rows, asked, 5)


def test_top_k_of_odd_vectors(spark):
    rows = [(0, [1.0, -1.0]), (1, [None, 0.0]), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, None), (5, [float("-inf"), 0.0])]
    rows += [(6, [0.004, 0.5]), (7, [-0.001]), (8, []), (9, [0.5, 0.5]), (9, [0.5, 0.5]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = table.select(F.col("vec_id").alias("id"), topk.quantised(F.col("embedding")).alias("vector"), F.lit("x").alias("rank"))
    kept = {r.id: r.vector for r in vectors.collect()}
    assert kept[0] == [256, -256] and kept[6] == [1, 128] and kept[7] == [-1] and kept[8] == []
    assert [kept[i] for i in range(1, 6)] == [None] * 5
    asked = vectors.where("id in (0, 4, 8, 9)")
    found = sorted(map(tuple, topk.top_k(vectors, asked, 5).collect()))
    plain = [(r.id, r.vector) for r in vectors.dropna().collect()]
    assert found == best(plain, [(i, kept[i]) for i in (0, 8, 9)], 5)
    assert topk.top_k(vectors.limit(0), asked, 5).count() == 0
    assert topk.top_k(vectors, asked.limit(0), 5).count() == 0


def test_top_k_of_large_components(spark):
    rows = [(1, [9e6, 0.0]), (2, [1.0, 1.0]), (50, [1.0, 0.0]), (3, [-3e10, 2.0]), (4, [2.0**40, -1.0]), (100, [-(2.0**10), 0.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = table.select(F.col("vec_id").alias("id"), topk.quantised(F.col("embedding")).alias("vector"))
    plain = [(r.id, r.vector) for r in vectors.collect()]
    found = sorted(map(tuple, topk.top_k(vectors, vectors.where("id % 50 = 0"), 3).collect()))
    assert found == best(plain, [(i, v) for i, v in plain if i % 50 == 0], 3)
    assert found[0][:3] == (50, 1, 4) and found[1][:3] == (50, 2, 1)
    extremes = spark.createDataFrame([(1, [-(2**63), 1]), (2, [2**63 - 1, 5]), (3, [0, 1])], "id long, vector array<long>")
    asked = extremes.where("id = 3")
    assert sorted(map(tuple, topk.top_k(extremes, asked, 5).collect())) == [(3, 1, 2, 5), (3, 2, 1, 1)]
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(extremes, extremes.where("id = 2"), 5).collect()
    with pytest.raises(Exception, match="64 bits"):
        table.select(topk.quantised(F.transform("embedding", lambda x: x * 2.0**50))).collect()


def poisson(u, mean):
    k, p, total = 0, math.exp(-mean), math.exp(-mean)
    while total <= u:
        k += 1
        p *= mean / k
        total += p
    return k


def test_replication_equals_brute_force(spark):
    rows = [(i, "x" * (1 + i % 9), f"s{i % 5 if i % 10 else 0}") for i in range(600)] + [(700, None, None), (701, "y" * 50, None)]
    docs = documents(spark, rows, "doc_id long, text string, source string").withColumn("Copy", F.lit("c")).withColumn("order", F.lit(1))
    targets = {"s0": 0.1, "s1": 0.4, "none": 0.2}
    size = {}
    for _, text, source in rows:
        key = source if source in targets else None
        size[key] = size.get(key, 0) + len(text or "")
    share = {"s0": 0.1, "s1": 0.4, None: 1 - sum(targets.values())}
    rate = {s: 2 * w / sum(share.values()) * sum(size.values()) / size[s] for s, w in share.items()}
    expected = []
    for i, _, source in rows:
        u = int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) / 2**52
        expected += [(i, n + 1) for n in range(poisson(u, rate[source if source in share else None]))]
    found = mixing.replicate(docs, targets, epochs=2.0)
    assert sorted((r.doc_id, r.copy) for r in found.collect()) == sorted(expected)
    assert found.columns == ["doc_id", "text", "source", "order", "copy"]
    assert found.where("order = 1").count() == len(expected)


def test_shares_come_near_their_targets(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('x', 100) AS text", "if(id % 3 = 0, 'hot', concat('s', id % 7)) AS source")
    found = mixing.replicate(docs, {"hot": 0.1, "s1": 0.5})
    count = {r[0]: r[1] for r in found.groupBy("source").count().collect()}
    total = sum(count.values())
    assert abs(count["hot"] / total - 0.1) < 0.01 and abs(count["s1"] / total - 0.5) < 0.02 and abs(total / 20_000 - 1) < 0.03
    ids = [r.doc_id for r in found.limit(200).collect()]
    assert ids != sorted(ids)


def test_mix_of_odd_rows(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.replicate(documents(spark, [], schema), {"a": 0.5}).count() == 0
    assert mixing.replicate(documents(spark, [(1, None, "a"), (2, "", None)], schema), {"a": 0.5}).count() == 0
    twice = mixing.replicate(documents(spark, [(None, "xx", "a"), (5, "yy", "a"), (5, "yy", "a")], schema), {"a": 1.0}, epochs=30.0)
    assert twice.where("doc_id = 5").count() % 2 == 0 and twice.where("doc_id is null").count() > 0
    with pytest.raises(ValueError, match="shares"):
        mixing.replicate(documents(spark, [], schema), {"a": 1.5})


def test_large_means_are_sums_of_draws(spark):
    """A few texts of a listed source that are to make half of a mix: 500 repetitions each, in eight draws."""
    rows = [(i, "x", "rare") for i in range(20)] + [(100 + i, "y" * 200, "hot") for i in range(100)]
    docs = documents(spark, rows, "doc_id long, text string, source string")
    found = {r[0]: r[1] for r in mixing.replicate(docs, {"rare": 0.5}).groupBy("doc_id").count().collect()}
    mean = 0.5 * 20_020 / 20
    draws = math.ceil(mean / mixing.DRAW_MEAN)
    for i in range(20):
        us = [int(hashlib.md5(f"mix#{j}:{i}".encode()).hexdigest()[:13], 16) / 2**52 for j in range(draws)]
        assert found[i] == sum(poisson(u, mean / draws) for u in us)
    assert abs(sum(found[i] for i in range(20)) / (20 * mean) - 1) < 0.05


def test_sql_of_the_mix_has_no_largest_count(spark):
    """The SQL for rates of one draw and of many, against the operator."""
    rows = [(i, "x" * (1 + i % 3), "src0") for i in range(12)] + [(100 + i, "y" * 400, "src9") for i in range(60)] + [(500, None, None)]
    docs = documents(spark, rows, "doc_id long, text string, source string").withColumns({"lang": F.lit("a"), "n_chars": F.lit(1)})
    found = Counter((r.doc_id, r.copy) for r in mixing.replicate(docs, {"src0": 0.4}).collect())
    with duckdb.connect() as con:
        frame = docs.toPandas()  # noqa: F841
        con.execute("CREATE VIEW documents AS SELECT * FROM frame")
        expected = con.execute(f"WITH {_mix_sql('documents', {'src0': 0.4})} SELECT doc_id, copy FROM copies").fetchall()
    assert max(n for i, n in found if i < 12) > 400 and found == Counter(expected)
