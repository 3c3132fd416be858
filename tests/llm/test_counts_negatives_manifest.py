from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from foyer.llm import hard_negatives, merkle, piece_counts
from foyer.llm.queries import QUERIES, WORD_PIECES
from helpers import documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"


def counted(texts):
    coder = Tokenizer.from_file(WORD_PIECES)
    coder.no_truncation()
    return [len(e.ids) for e in coder.encode_batch(texts, add_special_tokens=False)]


def test_token_counts_equal_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = {r.doc_id: r for r in QUERIES["op11_token_counts"](spark, FOLDER).collect()}
    assert len(found) == len(texts)
    for (i, text), n in zip(texts.items(), counted([t or "" for t in texts.values()]), strict=True):
        assert (found[i].n_bytes, found[i].n_tokens, found[i].over_limit) == (len((text or "").encode()), n, n > 2048)


def test_every_letter_splits_as_in_the_library():
    own = piece_counts.splitter(WORD_PIECES)
    points = [chr(c) for c in range(1, 0x260)] + list("İıſßẖΣς中文字कि👍🏽٣Ⅷ²​ 　 ﻿")
    texts = [f"a{c}b {c}{c} 1{c}'s{c} {c}'LL x" for c in points] + ["H̱ É é don't 'RE", "<|endoftext|>", "a<|startoftext|><|endoftext|>b c", "<|END"]
    for text, n in zip(texts, counted(texts), strict=True):
        words, marks = own.count(text)
        pieces = own.pieces(list(words))
        assert marks + sum(a * b for a, b in zip(words.values(), pieces, strict=True)) == n, repr(text)


def test_a_full_memory_of_words_starts_anew(monkeypatch):
    own, text = piece_counts.splitter(WORD_PIECES), "One é don't two 12 three's " * 5
    whole = own.count(text)
    monkeypatch.setattr(piece_counts, "REMEMBERED", 2)
    assert own.count(text) == whole
    near = dict.fromkeys(list(whole[0])[::2], 3)
    total, rest = own.summed(text, near, {})
    assert total == sum(3 * n for x, n in whole[0].items() if x in near) and rest == {x: n for x, n in whole[0].items() if x not in near}


@pytest.mark.parametrize(("head", "held"), [(65_536, 200_000), (3, 5)])
def test_token_counts_of_odd_texts(spark, monkeypatch, head, held):
    """Null, empty, repeated and very long texts, extra columns with clashing names, and no rows."""
    for name, value in (("HEAD", head), ("HELD", held)):
        monkeypatch.setattr(piece_counts, name, value)
    draw = random.Random(5)
    long = " ".join("".join(draw.choices("abcdéz", k=draw.randint(1, 9))) for _ in range(60_000))
    texts = [None, "", " \n", "One two one", "One two one", long, "x" * 40_000, "don't <|endoftext|> 12 ½ 中文"]
    rows = [(i % 7, t, "keep", i, "row") for i, t in enumerate(texts)]
    df = documents(spark, rows, "doc_id int, text string, N_TOKENS string, near int, c0 string")
    found = piece_counts.count_tokens(df, WORD_PIECES, limit=3)
    assert found.columns == ["doc_id", "near", "c0", "n_bytes", "n_tokens", "over_limit"]
    want = [(i % 7, i, len((t or "").encode()), n, n > 3) for i, (t, n) in enumerate(zip(texts, counted([t or "" for t in texts]), strict=True))]
    assert sorted((r.doc_id, r.near, r.n_bytes, r.n_tokens, r.over_limit) for r in found.collect()) == sorted(want)
    assert piece_counts.count_tokens(df.limit(0), WORD_PIECES).count() == 0


def mined(rows, asked, positives=5, negatives=10):
    """Brute force over (id, label, vector) rows."""
    out = []
    for a, label, v in asked:
        score = lambda w: sum(x * y for x, y in zip(v, w))  # noqa: E731, B023
        near = sorted((-score(w), i) for i, lab, w in rows if lab == label and i != a)[:positives]
        for p, i in near:
            hard = sorted((-score(w), j) for j, lab, w in rows if lab != label and 30 * -p <= 100 * score(w) <= 90 * -p)
            out += [(a, i, n + 1, j, -p, -s) for n, (s, j) in enumerate(hard[:negatives])]
    return sorted(out)


@pytest.mark.parametrize(("row_block", "anchor_block", "width"), [(8192, 2048, 6), (60, 2, 6), (100, 5, 70)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, row_block, anchor_block, width):
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", row_block)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", anchor_block)
    draw = random.Random(width)
    rows = [(i, i % 3, [draw.randint(-9, 12) for _ in range(width)]) for i in range(300)]
    rows += [(1000 + i, i % 2, [1, 2, 3, -4, 5, 6]) for i in range(40)]
    schema = "id long, label int, vector array<long>"
    asked = [r for r in rows if r[0] % 25 == 0]
    found = hard_negatives.mine(spark.createDataFrame(rows, schema), spark.createDataFrame(asked, schema))
    assert sorted(map(tuple, found.collect())) == mined(rows, asked)


def test_hard_negatives_of_odd_rows(spark):
    """Nulls, empty and zero vectors, one label only, negative scores, large components, clashing columns, no rows."""
    big = 2**30
    rows = [(0, 1, [4, 0]), (1, 1, [8, 1]), (2, 2, [4, 0]), (3, 2, [7, 0]), (4, None, [9, 9]), (5, 1, None), (None, 1, [1, 1])]
    rows += [(6, 3, []), (7, 3, [0, 0]), (8, 4, [-5, 0]), (9, 4, [5, 0]), (10, 5, [3, 3]), (11, 6, [big, -big]), (12, 6, [big, big]), (13, 7, [big // 2, 1])]
    schema = "id long, label long, vector array<long>"
    table = spark.createDataFrame(rows, schema).withColumn("rank", F.lit("x")).withColumn("body", F.lit(1))
    full = [r for r in rows if None not in r]
    assert sorted(map(tuple, hard_negatives.mine(table, table).collect())) == mined(full, full)
    assert hard_negatives.mine(table.limit(0), table).count() == hard_negatives.mine(table, table.limit(0)).count() == 0
    huge = spark.createDataFrame([(1, 1, [2**40]), (2, 1, [2**40])], schema)
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives.mine(huge, huge).collect()


def test_intervals_hold_every_score():
    draw = np.random.default_rng(3)
    vectors = draw.integers(-300, 300, (500, 48))
    body = hard_negatives.padded(vectors.tolist(), 64)
    turned = hard_negatives.rotated(body)
    assert np.allclose((turned**2).sum(axis=1), (body**2).sum(axis=1))
    align = np.abs(turned).sum(axis=1) / 8
    rest = np.sqrt(np.maximum(0, (turned**2).sum(axis=1) - align**2))
    codes = object.__new__(hard_negatives.Codes)
    codes.width, codes.code, codes.align, codes.rest = 64, hard_negatives.packed(turned >= 0), align, rest
    codes.length = np.sqrt((body.astype(float) ** 2).sum(axis=1))
    for query in body[:50]:
        low, high = codes.bounds(query)
        exact = body @ query
        assert ((low <= exact) & (exact <= high)).all()
        assert (high - low < 2.1 * codes.length * np.sqrt((query**2).sum())).all()


def test_components_of_vectors_are_whole_numbers(spark):
    rows = [(1, [0.5, -0.001]), (2, None), (3, [None]), (4, [float("nan")]), (5, [float("inf")]), (6, []), (7, [3e9])]
    vectors = spark.createDataFrame(rows, "id long, v array<float>").select("id", hard_negatives.whole_numbers(F.col("v")).alias("v"))
    assert {r.id: r.v for r in vectors.collect()} == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: [], 7: [768_000_000_000]}
    with pytest.raises(Exception, match="64 bits"):
        spark.createDataFrame([(1, [1e30])], "id long, v array<float>").select(hard_negatives.whole_numbers(F.col("v"))).collect()


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """All levels of a tree over the leaves."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def walk(levels, at, leaf):
    others = []
    for level in levels[:-1]:
        run = level[at // 8 * 8 : at // 8 * 8 + 8]
        others += run[: at % 8] + run[at % 8 + 1 :]
        run[at % 8] = leaf
        leaf, at = h(*run), at // 8
    return others, leaf


def manifest(rows):
    """Brute force over (key, group, leaf, found)."""
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(r[1], []).append(r)
    trees = {g: tree(r[2] for r in own) for g, own in groups.items()}
    top = tree(t[-1][0] for t in trees.values())
    out = []
    for place, (g, own) in enumerate(groups.items()):
        for at, (key, _, leaf, found) in enumerate(own):
            low, version = walk(trees[g], at, found)
            high, version = walk(top, place, version)
            out.append((key, leaf, trees[g][-1][0], top[-1][0], h(*low, *high), version, version == top[-1][0]))
    return out


def leaves(n_by_group):
    rows = []
    for group, n in n_by_group.items():
        for i in range(n):
            leaf = h(str(group), str(i))
            rows.append((i * 3, group, leaf, h(leaf) if zlib.crc32(str(i).encode()) % 3 == 0 else leaf))
    random.Random(1).shuffle(rows)
    return rows


@pytest.mark.parametrize("height", [4, 1, 2])
def test_manifest_equals_brute_force(spark, height):
    """Lone leaves, groups of one block and of several with a last run of one node, a null group, over 8 groups."""
    rows = leaves({None: 70, "": 1, "é": 8, "z": 9, "Z": 64, "en": 513, "a": 2, "b": 1, "c": 1, "d": 65})
    df = spark.createDataFrame(rows, "id long, lang string, leaf string, now string").repartition(5)
    built = merkle.build(df, "id", "lang", F.col("leaf"), height, found=F.col("now"))
    found = sorted(map(tuple, merkle.proofs(built, "found").collect()))
    assert found == sorted(manifest(rows)) and len({r[-1] for r in found}) == 2
    assert [r.root for r in built.roots().collect()] == [found[0][3]]


def test_manifest_of_odd_rows(spark):
    schema = "id long, lang string, leaf string, at int, grp string"
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    for rows in ([(5, None, "x")], [(1, "a", "x"), (2, "b", "y")], [(None, "a", "n"), (7, "a", "x"), (7, "a", "x"), (7, "a", "b"), (None, None, "n")]):
        df = spark.createDataFrame([(*r, 1, "g") for r in rows], schema)
        found = merkle.proofs(merkle.build(df, "id", "lang", F.col("leaf"))).collect()
        assert sorted(map(tuple, found), key=key) == sorted(manifest([(*r, r[2]) for r in rows]), key=key)
    empty = merkle.build(df.limit(0), "id", "lang", F.col("leaf"))
    assert merkle.proofs(empty).count() == 0 and empty.roots().count() == 0


def test_leaf_digest(spark):
    df = spark.createDataFrame([(1, None, "é"), (None, "", "a:b")], "a long, b string, c string")
    found = [r.d for r in df.select(merkle.leaf_digest([F.col("a"), F.col("b"), F.col("c")]).alias("d")).collect()]
    assert found == [h("1:1", "-", "2:é"), h("-", "0:", "3:a:b")]


def test_versions_share_all_untouched_nodes():
    block = merkle.Block([str(i) for i in range(100)], 100, 4)
    before, after = block.root, block.version(70, "new")
    assert before[0] == merkle.Block([str(i) for i in range(100)], 100, 4).root[0] != after[0]
    copied = 0
    stack = [(before, after)]
    while stack:
        a, b = stack.pop()
        if a is not b:
            copied += 1
            stack += zip(a[1], b[1], strict=True)
    assert copied == block.height + 1
    assert after[0] == merkle.Block(["new" if i == 70 else str(i) for i in range(100)], 100, 4).root[0]
