"""Near-duplicates by an LSH forest over MinHash signatures, confirmed on full sets.

A document's set is its distinct shingles of five words. Documents with one set
form a class, and classes are compared by their signatures. Each order of the
forest reads the signature from another place on, so it sorts the classes in its
own way and classes with a long common prefix stand together. The depth of the
prefix adapts to each region: it grows only while a region still has more than
``REGION`` classes. Inside a region, estimates from the whole signatures choose
the neighbours, and their links are confirmed on the full sets.

Regions too large at a depth are also compared with their pivot, the class at
the end of their heaviest path, so a class that resembles the centre of a huge
group is found however deep the group's regions lie.

The confirmed links are joined to components, and three steps see to it that no
link is lost to the choice of neighbours. In too large regions, neighbours by
longest common prefix that are in different components are confirmed until none
adds a link. What then is still outside the largest component of such a region
meets all classes of the regions with that component, block by block; and small
regions are read once more. In both, estimates only choose which classes of a
block may have a link between components; the full sets of these are compared
inside the block, which puts out no more links than join its parts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.tables import select_into
from .common import free_name, without
from .components import components

RESULT = ("n_shingles", "component_id", "kept")
SHINGLE = 5
#: A link needs this share, in hundredths, of the union in the intersection.
SIMILAR = 75
#: Values of a signature and orders of the forest.
HASHES, ORDERS = 128, 16
#: Classes of a region that are compared in pairs.
REGION = 512
#: Prefix lengths a region goes through while it is too large, and the one from which a large region counts as dense.
DEPTHS = (1, 2, 4, 8, 16, 32, 64, 128)
DENSE = 4
#: Values behind that prefix by which a dense region's classes are sorted, and how far apart neighbours are.
SORTED, REACH = 16, 3
#: Classes of a block of a dense region, and shingles of the classes whose sets a task compares.
BLOCK, HELD_SHINGLES = 2048, 4_000_000
#: Neighbours of a class in each region that are confirmed first.
NEIGHBOURS = 3
#: Equal values of two signatures from which a pair is confirmed: 58 of 100,
#: over four deviations below what a link of the least similarity has.
PROMISING = HASHES * 58 // 100
#: Pairs whose signatures are compared at once.
PAIR_BLOCK = 100_000

_MIX, _FINAL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_FACTORS = (np.random.default_rng(7).integers(0, 2**31, (2, HASHES), np.uint32) << 1 | 1).astype(np.uint32)


def shingles(text: str | None) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles.

    Words are what white space of ASCII leaves, A-Z lowered. Fewer than five
    words make one shingle of all of them; no words make an empty set.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    last = len(words) - width + 1
    out = np.full(last, width, np.uint64)
    for i in range(width):
        out = out * _MIX + codes[i : i + last]
    out = (out ^ (out >> np.uint64(32))) * _FINAL
    return np.unique(out ^ (out >> np.uint64(29)))


def signature(found: np.ndarray) -> np.ndarray:
    """The least value of the set under each of ``HASHES`` hash functions."""
    low, high = found.astype(np.uint32), (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(found), 2048):
        part = low[at : at + 2048, None] * _FACTORS[0] + high[at : at + 2048, None]
        least = np.minimum(least, part.min(axis=0))
    return least


def fingerprint(values: np.ndarray) -> bytes:
    """One byte for each value of a signature, to compare signatures by."""
    return (values * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8).tobytes()


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """For each row ``id``, the size ``n`` of its set, the set's 128-bit digest and its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            signs = [signature(s) for s in sets]
            columns = [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([x.astype(">u4").tobytes() for x in signs], pa.binary()),
                pa.array([fingerprint(x) for x in signs], pa.binary()),
            ]
            yield pa.record_batch(columns, ["id", "n", "digest", "sig", "print"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "id long, n long, digest binary, sig binary, print binary")


def prefix_keys(depths: Sequence[int]) -> list[Column]:
    """For each depth the hash of a prefix of the signature ``sig``, as the order ``order`` reads it."""
    step = 4 * (HASHES // ORDERS)
    return [
        F.xxhash64(F.lit(d), "order", F.expr(f"substring(concat(sig, sig), order * {step} + 1, {4 * d})")) for d in depths
    ]


def levels(classes: DataFrame) -> list[DataFrame]:
    """The forest level by level: ``region``, its ``size``, ``above`` it, its classes ``id`` and their ``order``.

    Only regions of two or more classes are listed, and only those above
    ``REGION`` have regions on the next level. Each level is written to the
    shared folder; whether one is empty is all the driver learns.
    """
    orders = F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("order")
    first = classes.select("id", "sig", orders).select("id", "order", *[k.alias("region") for k in prefix_keys(DEPTHS[:1])])
    entries, out = first.withColumn("above", F.lit(0).cast("long")), []
    for at in range(len(DEPTHS)):
        sizes = entries.groupBy("region").agg(F.count("*").alias("size")).where("size > 1")
        out.append(select_into(entries.join(sizes, "region")))
        big = out[-1].where(F.col("size") > REGION)
        if at + 1 == len(DEPTHS) or big.isEmpty():
            return out
        if at == 0:
            # Only classes of large regions take the keys of all deeper levels along.
            keys = F.array(*prefix_keys(DEPTHS[1:])).alias("keys")
            big = big.join(classes.select("id", "sig"), "id").select("id", "order", "region", keys)
        entries = big.select("id", "order", F.col("region").alias("above"), F.col("keys")[at].alias("region"), "keys")
    return out


def small_regions(forest: list[DataFrame]) -> DataFrame:
    """The regions whose classes are compared in pairs: ``region``, ``id``."""
    parts = [level.where(F.col("size") <= REGION).select("region", "id") for level in forest]
    return reduce(DataFrame.union, parts)


def pivot_pairs(forest: list[DataFrame]) -> DataFrame:
    """Pairs ``a``, ``b`` of the classes of too large regions with the region's pivot.

    The pivot of a region is that of its largest region on the next level, and
    on the last level the smallest class.
    """
    out, deeper = [], None
    for level in reversed(forest):
        heads = level.groupBy("region").agg(F.min("above").alias("above"), F.max("size").alias("size"), F.min("id").alias("pivot"))
        if deeper is not None:
            best = deeper.groupBy("above").agg(F.max_by("pivot", F.struct("size", "region")).alias("deep"))
            heads = heads.join(best.withColumnRenamed("above", "region"), "region", "left")
            heads = heads.select("region", "above", "size", F.coalesce("deep", "pivot").alias("pivot"))
        deeper = heads
        near = level.where(F.col("size") > REGION).select("region", "id").join(heads.select("region", "pivot"), "region")
        out.append(near.where("id <> pivot").select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")))
    return reduce(DataFrame.union, out).distinct()


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of batches that are sorted by ``key``, cut where one of its values ends."""
    held = None
    for batch in batches:
        now = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        values = now.column(key).to_numpy()
        # The last group may go on in the next batch.
        cut = len(values) - int((values == values[-1]).sum()) if len(values) else 0
        held = now.slice(cut).combine_chunks()
        if cut:
            yield now.slice(0, cut)
    if held is not None and held.num_rows:
        yield held


def columns_of(rows: pa.Table, *names: str) -> list[np.ndarray]:
    return [rows.column(c).to_numpy() for c in names]


def prints_of(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("print").to_pylist()), np.uint8).reshape(-1, HASHES)


def ends_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of one value starts, and how long it is."""
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return starts, np.diff(np.r_[starts, len(values)])


def likely(i: np.ndarray, j: np.ndarray, sizes: np.ndarray, roots: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the pairs those between two components that sizes and estimates allow to be links, and their equal values."""
    fits = (roots[i] != roots[j]) & (100 * np.minimum(sizes[i], sizes[j]) >= SIMILAR * np.maximum(sizes[i], sizes[j]))
    i, j = i[fits], j[fits]
    same = np.zeros(len(i), np.int64)
    for at in range(0, len(i), PAIR_BLOCK):
        part = slice(at, at + PAIR_BLOCK)
        same[part] = (prints[i[part]] == prints[j[part]]).sum(axis=1)
    fits = same >= PROMISING
    return i[fits], j[fits], same[fits]


def likely_pairs(rows: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
    """The likely pairs of whole regions, some regions at a time."""
    region, sizes, roots = columns_of(rows, "region", "n", "root")
    prints = prints_of(rows)
    starts, lengths = ends_of(region)
    # Blocks of regions with about PAIR_BLOCK pairs, a single region at least.
    block = np.cumsum(lengths * (lengths - 1) // 2) // PAIR_BLOCK
    for own in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(block)) + 1):
        pairs = [np.triu_indices(lengths[r], 1) for r in own]
        i = np.concatenate([starts[r] + p[0] for r, p in zip(own, pairs, strict=True)])
        j = np.concatenate([starts[r] + p[1] for r, p in zip(own, pairs, strict=True)])
        yield likely(i, j, sizes, roots, prints)


def pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    a, b = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def promising(rows: DataFrame) -> DataFrame:
    """Pairs ``a`` < ``b``: the best few of each class in each region that estimates and sizes allow to be links.

    ``rows`` has ``region``, ``id``, the set size ``n``, the signature's
    ``print`` and the component ``root`` so far; pairs inside one component are
    passed over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_groups(batches, "region"):
            (ids,) = columns_of(whole, "id")
            for i, j, same in likely_pairs(whole):
                best = nearest(i, j, same, ids, NEIGHBOURS)
                yield pair_batch(ids[i[best]], ids[j[best]])

    dealt = rows.select("region", "id", "n", "print", "root").repartition("region").sortWithinPartitions("region", "id")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def doubtful(rows: DataFrame) -> DataFrame:
    """The classes of small regions that may be linked with one of another component: ``block``, ``id``, ``n``, ``root``, ``asks``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_groups(batches, "region"):
            found = [np.unique(np.r_[i, j]) for i, j, _ in likely_pairs(whole)]
            found = pa.array(np.unique(np.concatenate(found)), pa.int64())
            columns = [whole.column(c).take(found).combine_chunks() for c in ("region", "id", "n", "root")]
            yield pa.record_batch([*columns, pa.array([True] * len(found), pa.bool_())], ["block", "id", "n", "root", "asks"])

    dealt = rows.select("region", "id", "n", "print", "root").repartition("region").sortWithinPartitions("region", "id")
    return dealt.mapInArrow(run, DOUBTFUL)


DOUBTFUL = "block long, id long, n long, root long, asks boolean"


def prefix_neighbours(level: DataFrame, classes: DataFrame, known: DataFrame) -> DataFrame:
    """Likely pairs ``a`` < ``b`` of different components that stand near each other in a sorted order of a dense region.

    ``level`` has the dense regions' ``region``, ``order`` and ``id``, ``known``
    for each class ``n``, ``print`` and ``root``. Regions are dealt by ranges of
    the order, so that one of any size lies in many tasks.
    """
    step = 4 * (HASHES // ORDERS)
    behind = F.expr(f"substring(concat(sig, sig), order * {step} + {4 * DENSE + 1}, {4 * SORTED})").alias("key")
    rows = level.join(classes.select("id", "sig").hint("merge"), "id").select("region", "id", behind)
    rows = rows.join(known.hint("merge"), "id").select("region", "key", "id", "n", "print", "root")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            now = pa.Table.from_batches([batch] if last is None else [*last.to_batches(), batch])
            last = now.slice(max(0, now.num_rows - REACH)).combine_chunks()
            region, ids, sizes, roots = columns_of(now, "region", "id", "n", "root")
            prints = prints_of(now)
            for gap in range(1, REACH + 1):
                i = np.flatnonzero(region[gap:] == region[: len(region) - gap])
                i, j, _ = likely(i, i + gap, sizes, roots, prints)
                if len(i):
                    yield pair_batch(ids[i], ids[j])

    dealt = rows.repartitionByRange("region", "key", "id").sortWithinPartitions("region", "key", "id")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def doubtful_strays(level: DataFrame, known: DataFrame) -> DataFrame:
    """Like :func:`doubtful` for dense regions: classes outside a region's largest component, and what they may be linked with.

    Regions with one largest component make one group; so classes meet whether
    or not they share a region of it. Sizes of sets fall into steps of 4 to 3,
    so that the ends of a link are at most one step apart. Strays and classes of
    a step are dealt into blocks of about ``BLOCK``, and each block of strays
    meets each block of classes.
    """
    rows = level.select("region", "id").join(known.select("id", "root").hint("merge"), "id")
    heavy = rows.groupBy("region", "root").agg(F.count("*").alias("many"))
    heavy = heavy.groupBy("region").agg(F.max_by("root", F.struct("many", "root")).alias("main"))
    members = rows.join(heavy, "region").select("main", "id").distinct()
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / SIMILAR))).cast("int")
    members = select_into(members.join(known.hint("merge"), "id").withColumn("step", step))
    near = F.explode(F.array(*[F.col("step") + d for d in (-1, 0, 1)])).alias("step")
    asked = members.where("root <> main").select("main", near, "id", "n", "print", "root")
    blocks = lambda c: F.ceil(F.count("*") / BLOCK).cast("int").alias(c)
    counts = members.groupBy("main", "step").agg(blocks("held"))
    counts = select_into(counts.join(asked.groupBy("main", "step").agg(blocks("asking")), ["main", "step"]))
    deal = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    told = asked.join(counts, ["main", "step"]).withColumn("at", deal("asking")).withColumn("of", every("held"))
    held = members.join(counts, ["main", "step"]).withColumn("of", deal("held")).withColumn("at", every("asking"))
    columns = [F.xxhash64("main", "step", "at", "of").alias("block"), "id", "n", "print", "root"]
    both = told.select(F.lit(True).alias("asks"), *columns).union(held.select(F.lit(False).alias("asks"), *columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_groups(batches, "block"):
            block, sizes, roots, asks = columns_of(whole, "block", "n", "root", "asks")
            prints, found = prints_of(whole), np.zeros(len(block), bool)
            for start, length in zip(*ends_of(block), strict=True):
                own = np.arange(start, start + length)
                told, held = own[asks[own]], own[~asks[own]]
                few = max(1, PAIR_BLOCK // max(1, len(held)))
                for at in range(0, len(told), few):
                    i = np.repeat(told[at : at + few], len(held))
                    i, j, _ = likely(i, np.tile(held, len(i) // max(1, len(held))), sizes, roots, prints)
                    found[i] = found[j] = True
            found = pa.array(np.flatnonzero(found), pa.int64())
            columns = [whole.column(c).take(found).combine_chunks() for c in ("block", "id", "n", "root", "asks")]
            yield pa.record_batch(columns, ["block", "id", "n", "root", "asks"])

    dealt = both.repartition("block").sortWithinPartitions("block", "id", "asks")
    return dealt.mapInArrow(run, DOUBTFUL)


def block_links(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that join the components of each block, by the full sets.

    ``rows`` is what :func:`doubtful` gives, ``texts`` has ``id`` and ``text``. A
    class that asks is compared with all others of its block. A block of more
    than ``HELD_SHINGLES`` shingles is cut into parts, and each part meets each.
    """
    rows = select_into(rows)
    parts = rows.groupBy("block").agg(F.ceil(F.sum("n") / HELD_SHINGLES).cast("int").alias("parts"))
    rows = rows.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pair = F.when(F.col("parts") == 1, F.col("block")).otherwise(
        F.xxhash64("block", F.least("part", "other"), F.greatest("part", "other"))
    )
    rows = rows.select(pair.alias("block"), "id", "root", "asks")
    rows = rows.hint("merge").join(texts, "id").select("block", "id", "root", "asks", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_groups(batches, "block"):
            block, ids, roots, asks = columns_of(whole, "block", "id", "root", "asks")
            text, found = whole.column("text"), []
            for start, length in zip(*ends_of(block), strict=True):
                own = slice(start, start + length)
                sets = [shingles(t) for t in text.slice(start, length).to_pylist()]
                found += joining(ids[own], roots[own], asks[own], sets)
            if found:
                yield pair_batch(*np.array(found, np.int64).T)

    dealt = rows.repartition("block").sortWithinPartitions("block", "id", "asks")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def joining(ids: np.ndarray, roots: np.ndarray, asks: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between the sets that ask and all others, as many as join components."""
    top = {r: r for r in roots.tolist()}

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    sizes = np.array([len(s) for s in sets])
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    starts, seen, out = ends - sizes, np.zeros(len(values), np.int32), []
    for at in np.flatnonzero(asks):
        own = codes[starts[at] : ends[at]]
        seen[own] = 1
        common = np.add.reduceat(seen[codes], starts)
        seen[own] = 0
        for other in np.flatnonzero(100 * common >= SIMILAR * (sizes[at] + sizes - common)):
            a, b = find(int(roots[at])), find(int(roots[other]))
            if a != b:
                top[max(a, b)] = min(a, b)
                out.append((int(ids[at]), int(ids[other])))
    return out


def nearest(i: np.ndarray, j: np.ndarray, same: np.ndarray, ids: np.ndarray, neighbours: int) -> np.ndarray:
    """The numbers of the pairs that are among the best of one of their classes."""
    own, other = np.r_[i, j], np.r_[j, i]
    order = np.lexsort((ids[other], -np.r_[same, same], own))
    first = np.r_[True, own[order][1:] != own[order][:-1]] if len(order) else np.empty(0, bool)
    place = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return np.unique(order[place < neighbours] % max(1, len(i)))


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough; ``texts`` has ``id`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, np.empty(0, np.uint64)
        for batch in batches:
            keep = []
            a, b, one, two = (batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))
            for k in range(batch.num_rows):
                if a[k] != last:
                    last, known = a[k], shingles(one[k])
                other = shingles(two[k])
                common = len(np.intersect1d(known, other, assume_unique=True))
                if 100 * common >= SIMILAR * (len(known) + len(other) - common):
                    keep.append(k)
            yield pa.record_batch([pa.array([x[k] for k in keep], pa.int64()) for x in (a, b)], ["a", "b"])

    # Pairs and texts grow with the corpus: neither is broadcast, however few there are.
    both = pairs.hint("merge").join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.hint("merge").join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def joined(roots: DataFrame, more: DataFrame) -> DataFrame:
    """``roots`` after further links, of which each is first taken to the roots of its ends."""
    ends = more
    for end in ("a", "b"):
        known = roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
        ends = ends.join(known, end, "left").withColumn(end, F.coalesce(f"{end}_root", end)).select("a", "b")
    higher = components(ends).select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = roots.join(higher, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    # A root, or a class that had no link before, stands for itself.
    own = higher.select(F.col("root").alias("node"), F.col("top").alias("root")).join(moved.select("node"), "node", "left_anti")
    return moved.union(own)


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row ``id`` its set size ``n_shingles`` and its ``component_id``.

    Documents are linked when their sets have at least three quarters of their
    union in common; a component's id is the smallest id in it. A text that is
    null or has no word is linked with nothing. Ids are whole numbers; a row
    with a null id is a component of its own without id, and rows that repeat an
    id are one document with each of their texts.
    """
    rows = select_into(signed(docs, id_col, text_col))
    filled = rows.where("n > 0 and id is not null")
    classes = select_into(
        filled.groupBy("digest").agg(F.min("id").alias("rep"), *[F.first(c).alias(c) for c in ("n", "sig", "print")])
    )
    # Two classes may name one id where ids repeat; their links then meet in it.
    classes = classes.withColumnRenamed("rep", "id")
    forest = levels(classes)
    prints = classes.select("id", "n", "print")
    found = small_regions(forest)
    alone = found.join(prints.hint("merge"), "id").withColumn("root", F.col("id"))
    pairs = select_into(promising(alone).union(pivot_pairs(forest)).distinct())
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    texts = select_into(texts.join(needed.hint("merge"), "id", "left_semi"))
    roots = select_into(components(select_into(confirmed(pairs, texts))))

    def rooted() -> DataFrame:
        known = prints.join(roots.withColumnRenamed("node", "id"), "id", "left")
        return select_into(known.withColumn("root", F.coalesce("root", "id")))

    known, at = rooted(), DEPTHS.index(DENSE)
    dense = forest[at].where(F.col("size") > REGION).select("region", "order", "id") if len(forest) > at + 1 else None
    while dense is not None:
        more = select_into(confirmed(prefix_neighbours(dense, classes, known), texts))
        if more.isEmpty():
            break
        roots = select_into(joined(roots, more))
        known = rooted()
    open_classes = doubtful(found.join(known.hint("merge"), "id"))
    if dense is not None:
        open_classes = open_classes.union(doubtful_strays(dense, known))
    more = select_into(block_links(open_classes, texts))
    if not more.isEmpty():
        roots = select_into(joined(roots, more))
    reps = filled.join(classes.select("digest", F.col("id").alias("rep")), "digest")
    named = reps.join(roots, F.col("rep") == F.col("node"), "left").select("id", "n", F.coalesce("root", "rep").alias("component_id"))
    empty = rows.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component_id"))
    return named.union(empty).withColumnRenamed("n", "n_shingles")


def mark_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id`` and ``kept``, true for the one row that stays of a component.

    Ids should be unique: rows that repeat one get the component of their id.
    Extra columns pass through, but for those named like a result column.
    """
    docs = without(docs, RESULT, keep=(id_col, text_col))
    found = near_components(docs, id_col, text_col).groupBy("id").agg(F.max("n_shingles").alias("n_shingles"), F.min("component_id").alias("component_id"))
    own, key = F.col(f"`{id_col}`").cast("long"), free_name(docs, "near_id")
    joined = docs.join(found.withColumnRenamed("id", key), own.eqNullSafe(F.col(key)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, "n_shingles", "component_id", own.eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`mark_near_copies` keeps, with their own columns."""
    marked = mark_near_copies(docs, id_col, text_col)
    return marked.where("kept").select(*[F.col(f"`{c}`") for c in docs.columns if c in marked.columns])
