"""Hard negatives of anchors by rotated one-bit codes.

Every vector is rotated by signs and Hadamard transforms and coded by one bit for
each component: its sign. Beside the code stand the vector's alignment with it,
``a = <x, c>`` for the unit vector ``c`` of the signs, and the length of what the
code leaves over, ``rest = |x - a c|``. An anchor is rotated alike and cut into
bit planes; its product with a code is a sum of popcounts, and with ``s = <q, c>``

    <q, x> = a s + <q, x - a c>,   |<q, x - a c>| <= |q - s c| rest

by Cauchy and Schwarz, as both factors are at right angles to ``c``. The planes'
rounding adds a known bound. So each score lies in an interval that no score
leaves; rows whose interval can't reach what is asked for are passed over, and
the integer scores of all others are computed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.tables import select_into

#: Rows and anchors of a block. They bound what a task holds, not what is found.
ROW_BLOCK, ANCHOR_BLOCK = 8_192, 2_048
#: Bit planes of an anchor, and rounds of the rotation.
PLANES, ROUNDS = 8, 2
#: Share of the lengths' product that rounding of floating point may take.
SLACK = 1e-9


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rows turned by random signs and Hadamard transforms; their width is a power of two."""
    out, width = vectors.astype(np.float64), vectors.shape[1]
    for turn in range(ROUNDS):
        out = out * np.random.default_rng(turn).choice([-1.0, 1.0], width)
        half = 1
        while half < width:
            pairs = out.reshape(len(out), -1, 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), width)
            half *= 2
        out = out / np.sqrt(width)
    return out


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    words = -(-bits.shape[1] // 64)
    out = np.zeros((len(bits), words * 8), np.uint8)
    small = np.packbits(bits, axis=1, bitorder="little")
    out[:, : small.shape[1]] = small
    return out.view(np.uint64)


def padded(vectors: list[list[int]], width: int) -> np.ndarray:
    """Rows of components; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for at, row in enumerate(vectors):
        out[at, : len(row)] = row
    return out


def coded(rows: DataFrame, width: int) -> DataFrame:
    """``id``, ``label`` and, for each row, its components ``body``, its ``code``, ``align`` and ``rest``."""
    names = ["id", "label", "body", "code", "align", "rest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = padded(batch.column(2).to_pylist(), width)
            turned = rotated(body)
            align = np.abs(turned).sum(axis=1) / np.sqrt(width)
            rest = np.sqrt(np.maximum(0, (turned**2).sum(axis=1) - align**2))
            code = packed(turned >= 0)
            columns = [batch.column(0), batch.column(1), *[pa.array([r.tobytes() for r in x], pa.binary()) for x in (body, code)]]
            yield pa.record_batch([*columns, pa.array(align), pa.array(rest)], names)

    plain = rows.select(F.col("id").cast("long"), F.col("label").cast("long"), "vector")
    return plain.mapInArrow(run, "id long, label long, body binary, code binary, align double, rest double")


class Codes:
    """The coded rows of one block, in order of their ids."""

    def __init__(self, rows: pa.Table, width: int):
        rows = rows.sort_by("id")
        self.width = width
        self.ids, self.labels, self.align, self.rest = (rows.column(c).to_numpy() for c in ("id", "label", "align", "rest"))
        self.body = np.frombuffer(b"".join(rows.column("body").to_pylist()), np.int64).reshape(-1, width)
        self.code = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint64).reshape(len(self.ids), -1)
        self.length = np.sqrt((self.body.astype(np.float64) ** 2).sum(axis=1))
        self.largest = max((abs(int(x)) for x in (self.body.min(initial=0), self.body.max(initial=0))), default=0)

    def bounds(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the ends of an interval that holds its score."""
        turned = rotated(query[None])[0]
        low, high = turned.min(), turned.max()
        step = (high - low) / (2**PLANES - 1) or 1.0
        levels = np.rint((turned - low) / step).astype(np.int64)
        planes = packed((levels >> np.arange(PLANES)[:, None] & 1).astype(np.uint8))
        ones = np.bitwise_count(self.code).sum(axis=1).astype(np.int64)
        both = sum(np.bitwise_count(self.code & plane).sum(axis=1).astype(np.int64) << b for b, plane in enumerate(planes))
        root = np.sqrt(self.width)
        along = (low * (2 * ones - self.width) + step * (2 * both - int(levels.sum()))) / root
        off = np.abs(turned - (low + step * levels)).sum() / root
        least = np.maximum(0, np.abs(along) - off)
        length = np.sqrt((turned**2).sum())
        beside = np.sqrt(np.maximum(0, length**2 - least**2))
        half = self.align * off + beside * self.rest + SLACK * (1 + length * self.length)
        middle = self.align * along
        return middle - half, middle + half

    def scores(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The integer scores of the rows; one beyond 64 bits is an error."""
        body = self.body[rows]
        most = self.largest * max(abs(int(query.min(initial=0))), abs(int(query.max(initial=0)))) * self.width
        if most < 2**53:
            return (body.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
        if most < 2**63:
            return body @ query
        exact = body.astype(object) @ query.astype(object)
        if any(abs(x) >= 2**63 for x in exact):
            raise OverflowError("a score does not fit 64 bits")
        return exact.astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def kth_highest(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def own_best(codes: Codes, anchor: int, label: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids and scores of the block's ``k`` best rows of the anchor's label but with another id."""
    rows = np.flatnonzero((codes.labels == label) & (codes.ids != anchor))
    if not len(rows):
        return rows, rows
    low, high = (x[rows] for x in codes.bounds(query))
    rows = rows[high >= kth_highest(low, k)]
    scores = codes.scores(query, rows)
    top = best(scores, codes.ids[rows], k)
    return codes.ids[rows[top]], scores[top]


def within(codes: Codes, label: int, query: np.ndarray, ranges: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each range of scores the ids and scores of the block's ``k`` best rows of other labels in it."""
    rows = np.flatnonzero(codes.labels != label)
    low, high = (x[rows] for x in codes.bounds(query))
    wanted = []
    for first, last in ranges:
        # Rows that certainly lie in the range say how high its best ones reach at least.
        sure = low[(low >= first) & (high <= last)]
        wanted.append((low <= last) & (high >= max(first, kth_highest(sure, k))))
    any_range = np.logical_or.reduce(wanted) if wanted else np.zeros(len(rows), bool)
    rows = rows[any_range]
    scores = codes.scores(query, rows)
    out = []
    for (first, last), open_rows in zip(ranges, wanted, strict=True):
        fits = np.flatnonzero(open_rows[any_range] & (scores >= first) & (scores <= last))
        top = fits[best(scores[fits], codes.ids[rows[fits]], k)]
        out.append((codes.ids[rows[top]], scores[top]))
    return out


def _dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
    every = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
    return df.select("*", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias(own), every)


def _empty(schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    return pa.table([pa.array([], t) for _, t in schema], [n for n, _ in schema])


def mine(
    rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90
) -> DataFrame:
    """For each anchor and positive the hardest negatives within a share of the positive's score.

    Both frames have ``id``, ``label`` and ``vector`` (array of long); rows with
    a null in one of them take no part. A score is the integer inner product, a
    shorter vector ending in zeros; higher ones come first, ties by smaller id.
    An anchor's positives are its first ``positives`` rows of its label with
    another id. Its negatives for one of them are the first ``negatives`` rows
    of other labels with ``least * p <= 100 * n <= most * p`` for the scores
    ``p`` and ``n``: none where ``p`` is negative. Returns ``anchor_id``,
    ``positive_id``, ``rank`` from 1, ``negative_id``, ``positive_score`` and
    ``negative_score``. Rows that repeat an id are candidates each, and count as
    positives each; of anchors that repeat one, the one whose label and vector
    sort first is asked. A score beyond 64 bits is an error.

    Codes are built once and written; blocks of rows meet blocks of anchors.
    """
    rows = rows.select("id", "label", "vector").dropna()
    anchors = anchors.select("id", "label", "vector").dropna()
    size = F.size("vector").alias("size")
    width = rows.select(size).union(anchors.select(size)).agg(F.max("size")).first()[0] or 1
    width = 1 << (width - 1).bit_length()
    index = select_into(coded(rows, width))
    asked = anchors.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("s")).select("id", "s.*")
    asked = select_into(coded(asked, width).select("id", "label", "body"))
    n_rows, n_asked = index.count(), asked.count()
    row_blocks, anchor_blocks = -(-n_rows // ROW_BLOCK) or 1, -(-n_asked // ANCHOR_BLOCK) or 1
    held = _dealt(index, "row_block", row_blocks, "anchor_block", anchor_blocks).groupBy("anchor_block", "row_block")

    def queries(table: pa.Table) -> Iterator[tuple[int, int, np.ndarray]]:
        for one, label, body in zip(*(table.column(c).to_pylist() for c in ("id", "label", "body")), strict=True):
            yield one, label, np.frombuffer(body, np.int64)

    pair = [("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())]

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            codes = Codes(right, width)
            for one, label, query in queries(left):
                ids, scores = own_best(codes, one, label, query, positives)
                found.append((np.full(len(ids), one), ids, scores))
        if not found:
            return _empty(pair)
        return pa.table([pa.array(np.concatenate(c), pa.int64()) for c in zip(*found, strict=True)], [n for n, _ in pair])

    meet = _dealt(asked, "anchor_block", anchor_blocks, "row_block", row_blocks).groupBy("anchor_block", "row_block")
    near = meet.cogroup(held).applyInArrow(nearest, "anchor_id long, positive_id long, positive_score long")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    known = near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score", "place")).alias("pairs"))
    asked = select_into(asked.join(known.withColumnRenamed("anchor_id", "id"), "id"))

    out = [*pair, ("place", pa.int32()), ("negative_id", pa.int64()), ("negative_score", pa.int64())]

    def hardest(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            codes = Codes(right, width)
            for (one, label, query), pairs in zip(queries(left), left.column("pairs").to_pylist(), strict=True):
                # ceil(least * p / 100) and floor(most * p / 100), in whole numbers.
                ranges = [(-(-least * p["positive_score"] // 100), most * p["positive_score"] // 100) for p in pairs]
                for p, (ids, scores) in zip(pairs, within(codes, label, query, ranges, negatives), strict=True):
                    same = [np.full(len(ids), x) for x in (one, p["positive_id"], p["positive_score"], p["place"])]
                    found.append((*same, ids, scores))
        if not found:
            return _empty(out)
        columns = [pa.array(np.concatenate(c), t) for c, (_, t) in zip(zip(*found, strict=True), out, strict=True)]
        return pa.table(columns, [n for n, _ in out])

    meet = _dealt(asked, "anchor_block", anchor_blocks, "row_block", row_blocks).groupBy("anchor_block", "row_block")
    schema = "anchor_id long, positive_id long, positive_score long, place int, negative_id long, negative_score long"
    hard = meet.cogroup(held).applyInArrow(hardest, schema)
    # A repeated id may be two positives of an anchor; their places tell them apart.
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    hard = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return hard.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) for each component, as long; null where the vector is null or has a null or non-finite component.

    A component beyond 64 bits is an error.
    """

    def one(x: Column) -> Column:
        scaled = x.cast("double") * F.lit(float(scale))
        fits = (scaled >= F.lit(-(2.0**63))) & (scaled < F.lit(2.0**63))
        return F.when(fits, F.floor(scaled)).otherwise(F.raise_error(F.lit("a component does not fit 64 bits")).cast("long"))

    finite = lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x)
    return F.when(F.forall(vector, finite), F.transform(vector, one))
