from __future__ import annotations

import random

import pytest
from foyer.llm import neardup
from foyer.llm.components import components
from foyer.llm.exact import drop_copies, mark_copies
from helpers import documents, near_components


def test_exact_groups(spark):
    rows = [(1, "Abc"), (2, "aBC"), (3, "É"), (4, "é"), (5, None), (6, ""), (None, "abc"), (7, "x"), (7, "x")]
    found = {(r.doc_id, r.text): r for r in mark_copies(documents(spark, rows)).collect()}
    assert len(found) == 8 and found[(1, "Abc")].keep_id == 2
    assert found[(2, "aBC")].kept and not found[(1, "Abc")].kept and not found[(None, "abc")].kept
    assert found[(1, "Abc")].group_size == 3
    assert found[(3, "É")].kept and found[(4, "é")].kept
    assert found[(5, None)].keep_id == 6 and found[(6, "")].group_size == 2
    assert found[(7, "x")].group_size == 2 and found[(7, "x")].kept


def test_exact_without_rows_and_with_clashing_columns(spark):
    schema = "doc_id long, text string, KEPT string, salt int, keep long, norm_text string, size int"
    assert mark_copies(documents(spark, [], schema)).count() == 0
    marked = mark_copies(documents(spark, [(None, "a", "x", 1, 2, "n", 3)], schema))
    row = marked.first()
    assert row.kept is True and row.salt == 1 and row["keep"] == 2 and row.size == 3 and row.keep_id is None
    assert drop_copies(documents(spark, [(1, "a", "x", 1, 2, "n", 3)], schema)).count() == 1


def test_exact_hot_text(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "if(id % 3 = 0, repeat('Hot ', 50), concat('t', id)) AS text")
    found = mark_copies(docs.repartition(7))
    assert found.where("group_size = 1667 and keep_id = 4998").count() == 1667
    assert found.where("kept").count() == 3334


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(10, 60)]
    star = [(100, i) for i in range(101, 140)]
    rows = chain + star + [(5, 5), (200, 199), (199, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert {found[i] for i in range(10, 61)} == {10}
    assert {found[i] for i in range(100, 140)} == {100}
    assert found[200] == found[199] == 199 and 5 not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_rows(seed, group, edits):
    """A base text and copies of it with random words replaced, and texts that share one passage."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefghijklmnop", k=6))
    base = [word() for _ in range(150)]
    texts = [base]
    for _ in range(group):
        copy = list(base)
        for at in draw.sample(range(150), draw.randint(1, edits)):
            copy[at] = word()
        texts.append(copy)
    passage = base[:30]
    texts += [passage + [word() for _ in range(60)] for _ in range(group)]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("region", [512, 8])
def test_near_components_equal_brute_force(spark, monkeypatch, region):
    monkeypatch.setattr(neardup, "REGION", region)
    rows = near_rows(3, 60, 6)
    found = neardup.mark_near_copies(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == near_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_components_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Two words"), (5, "two\tWORDS"), (6, "É x"), (7, "é x"), (None, "two words")]
    rows += [(8, "a b c d e"), (9, "a b c d e a b c d e"), (10, "w " * 200_000), (11, "w " * 5)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.mark_near_copies(documents(spark, rows)).collect()}
    assert found[1] == (0, 1) and found[2] == (0, 2) and found[3] == (0, 3)
    assert found[4] == found[5] == (1, 4)
    assert found[6] == (1, 6) and found[7] == (1, 7)
    assert found[8] == (1, 8) and found[9] == (5, 9)
    assert found[10] == found[11] == (1, 10)
    assert found[None] == (1, None)


def test_near_components_without_rows_and_with_clashing_columns(spark):
    schema = "doc_id long, text string, id int, n int, kept string, sig string"
    assert neardup.mark_near_copies(documents(spark, [], schema)).count() == 0
    row = neardup.mark_near_copies(documents(spark, [(3, "a b", 1, 2, "x", "y"), (3, "a b", 1, 2, "x", "y")], schema)).collect()
    assert len(row) == 2 and row[0].kept is True and row[0].id == 1 and row[0].sig == "y"


def test_late_links_join_components(spark):
    roots = components(spark.createDataFrame([(1, 2), (5, 6), (8, 9)], "a long, b long"))
    more = spark.createDataFrame([(2, 6), (3, 9), (20, 21)], "a long, b long")
    found = {r.node: r.root for r in neardup.joined(roots, more).collect()}
    assert found == {1: 1, 2: 1, 5: 1, 6: 1, 3: 3, 8: 3, 9: 3, 20: 20, 21: 20}


@pytest.mark.parametrize("block", [2048, 5])
def test_strays_of_dense_regions_meet_the_whole_group(spark, monkeypatch, block):
    """Classes 0 to 39 form one component of two regions; 40 and 41 resemble two of them only, 42 none."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    draw = random.Random(6)
    prints = [bytearray(draw.randbytes(128)) for _ in range(43)]
    for stray, near in ((40, 7), (41, 33)):
        prints[stray] = prints[near][:90] + prints[stray][90:]
    known = [(i, 100 if i != 41 else 80, prints[i], 0 if i < 40 else i) for i in range(43)]
    known = spark.createDataFrame(known, "id long, n long, print binary, root long")
    level = spark.createDataFrame([(9 if i % 2 else 8, i, 0) for i in range(43)], "region long, id long, order int")
    found = neardup.doubtful_strays(level, known).collect()
    assert {r.id for r in found if r.asks} == {40, 41} and {r.id for r in found if not r.asks} == {7, 33}
    by_block = {}
    for r in found:
        by_block.setdefault(r.block, set()).add(r.id)
    assert any({40, 7} <= ids for ids in by_block.values()) and any({41, 33} <= ids for ids in by_block.values())


@pytest.mark.parametrize("held", [4_000_000, 40])
def test_blocks_put_out_links_that_join_components(spark, monkeypatch, held):
    monkeypatch.setattr(neardup, "HELD_SHINGLES", held)
    words = [f"w{i}" for i in range(24)]
    # 0 to 9 differ in the last word; 10 to 12 differ from them in the last two; 13 is another text.
    texts = [[*words[:-1], f"x{i}"] for i in range(10)] + [[*words[:-2], f"y{i}", f"z{i}"] for i in range(3)] + [[f"v{i}" for i in range(24)]]
    rows = [(1, i, 20, 0 if i < 10 else i, i >= 10) for i in range(14)] + [(2, 0, 20, 0, True), (2, 13, 20, 13, True)]
    rows = spark.createDataFrame(rows, neardup.DOUBTFUL)
    texts = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "id long, text string")
    links = neardup.block_links(rows, texts).collect()
    roots = neardup.joined(spark.createDataFrame([(i, 0) for i in range(10)], "node long, root long"), spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in roots.collect()} == dict.fromkeys(range(13), 0)
    assert len(links) <= (3 if held > 40 else 60)


@pytest.mark.parametrize("seed", [11, 12])
def test_links_to_variants_alone_equal_brute_force(spark, monkeypatch, seed):
    """A large group of variants of one text, and texts that are linked to one variant only."""
    monkeypatch.setattr(neardup, "REGION", 4)
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefghijklmnop", k=6))
    base = [word() for _ in range(300)]
    rows = [base]
    for _ in range(150):
        copy = list(base)
        for at in draw.sample(range(300), 6):
            copy[at] = word()
        rows.append(copy)
    for variant in rows[1:101]:
        copy = list(variant)
        for at in draw.sample(range(2, 298, 6), 8):
            copy[at] = word()
        rows.append(copy)
    rows = [(i, " ".join(t)) for i, t in enumerate(rows)]
    found = neardup.mark_near_copies(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == near_components(rows)
