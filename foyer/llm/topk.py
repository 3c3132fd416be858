"""Exact top-k search by inner product over a bit-sliced index.

Rows are dealt into blocks. A block's index holds each attribute as bit slices:
one bitmap over the rows for each binary digit. A query adds the slices of all
attributes, each as often as the query's digits ask, with carry-save adders on
whole bitmaps, which leaves the scores of all rows as slices again. The top rows
are then picked from the most significant slice downward, and the rows at the
boundary, which all have one score, by the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.tables import select_into

#: Rows and queries of a block. They bound what a task holds, not what is found.
ROW_BLOCK, QUERY_BLOCK = 16_384, 256


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) for each component, as long; null where the vector takes no part.

    That is a null vector, or one with a component that is null or not finite. A
    component beyond 64 bits is an error.
    """

    def one(x: Column) -> Column:
        scaled = x.cast("double") * F.lit(float(scale))
        fits = (scaled >= F.lit(-(2.0**63))) & (scaled < F.lit(2.0**63))
        return F.when(fits, F.floor(scaled)).otherwise(F.raise_error(F.lit("a component does not fit 64 bits")).cast("long"))

    finite = lambda x: F.coalesce((F.abs(x.cast("double")) < F.lit(float("inf"))) & ~F.isnan(x), F.lit(False))
    return F.when(F.forall(vector, finite), F.transform(vector, one))


def sliced(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Bit slices of the rows' components above the least of their column.

    Returns the slices as (attribute, digit, word), the least components, and
    the number of digits.
    """
    rows, width = vectors.shape
    least = vectors.min(axis=0) if rows else np.zeros(width, np.int64)
    # Differences of 64-bit numbers fit 64 bits without a sign.
    above = (vectors.view(np.uint64) - least.view(np.uint64)).T
    digits = max(1, int(above.max(initial=0)).bit_length())
    words = -(-rows // 64)
    planes = np.zeros((width, digits, words * 8), np.uint8)
    for digit in range(digits):
        bits = np.packbits((above >> np.uint64(digit) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little")
        planes[:, digit, : bits.shape[1]] = bits
    return planes.reshape(width, digits, words * 8).view(np.uint64), least, digits


def added(planes: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """The slices of the sum of all planes, each shifted by its weight, least significant first.

    Three bitmaps of one weight make a sum of that weight and a carry of the next.
    """
    out, carried, weight, last = [], [], 0, int(weights.max(initial=-1))
    while weight <= last or carried:
        stack = planes[weights == weight]
        if carried:
            stack = np.concatenate([stack, *carried])
        carried = []
        while len(stack) > 1:
            three = len(stack) // 3
            if three:
                a, b, c = stack[:three], stack[three : 2 * three], stack[2 * three : 3 * three]
                both = a ^ b
                carried.append((a & b) | (c & both))
                stack = np.concatenate([both ^ c, stack[3 * three :]])
            else:
                carried.append((stack[0] & stack[1])[None])
                stack = (stack[0] ^ stack[1])[None]
        out.append(stack[0] if len(stack) else np.zeros(planes.shape[1], np.uint64))
        weight += 1
    return out


class Block:
    """The bit-sliced index of one block of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        planes, self.least, self.digits = sliced(vectors[order])
        self.words = planes.shape[2]
        # Behind the slices stand their complements, for negative components of a query.
        self.planes = np.concatenate([planes, ~planes]).reshape(-1, self.words)
        self.every = np.zeros(self.words * 64, np.uint8)
        self.every[: len(ids)] = 1
        self.every = np.packbits(self.every, bitorder="little").view(np.uint64)

    def slices(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """The slices of all rows' scores, and what is to be added to each score."""
        width, size = len(self.least), np.where(query < 0, -query.view(np.uint64), query.view(np.uint64))
        bits = max(1, int(size.max(initial=0)).bit_length())
        attribute, shift = np.nonzero(size[:, None] >> np.arange(bits, dtype=np.uint64) & np.uint64(1))
        base = np.where(query[attribute] < 0, width, 0) + attribute
        which = base[:, None] * self.digits + np.arange(self.digits)
        weights = shift[:, None] + np.arange(self.digits)
        signed = query.tolist()
        rest = sum(q * x for q, x in zip(signed, self.least.tolist(), strict=True)) + sum(q for q in signed if q < 0) * (2**self.digits - 1)
        return added(self.planes[which.ravel()], weights.ravel()), rest

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best ``k`` rows other than the query's own, ties to the smaller id."""
        slices, rest = self.slices(query)
        open_rows, sure, found = self.every.copy(), np.zeros(self.words, np.uint64), 0
        for own in range(*np.searchsorted(self.ids, [query_id, query_id + 1])):
            open_rows[own // 64] &= ~(np.uint64(1) << np.uint64(own % 64))
        for one in reversed(slices):
            high = open_rows & one
            more = int(np.bitwise_count(high).sum())
            if found + more > k:
                open_rows = high
            else:
                sure, found, open_rows = sure | high, found + more, open_rows & ~one
            if found == k:
                break
        rows = [places(sure), places(open_rows)[: k - found]]
        rows = np.concatenate(rows)
        score = [rest] * len(rows)
        for weight, one in enumerate(slices):
            for at in np.flatnonzero(one[rows // 64] >> (rows % 64).astype(np.uint64) & np.uint64(1)):
                score[at] += 1 << weight
        if any(abs(x) >= 2**63 for x in score):
            raise OverflowError("a score does not fit 64 bits")
        score = np.array(score, np.int64)
        order = np.lexsort((self.ids[rows], -score))
        return self.ids[rows][order], score[order]


def places(bitmap: np.ndarray) -> np.ndarray:
    """The numbers of the set bits, in order."""
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of components; shorter vectors end in zeros."""
    out = np.zeros((len(column), width), np.int64)
    for at, row in enumerate(column.to_pylist()):
        out[at, : len(row)] = row
    return out


def top_k(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """For each query its ``k`` best rows: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Both have ``id`` and ``vector``, an array of long; rows with a null in either
    take no part. The score is the integer inner product, a shorter vector ending
    in zeros; ties go to the smaller id. A query is not compared with rows of its
    own id. Where rows repeat an id, each is a candidate; of queries that repeat
    one, the vector that sorts first is asked. A score among the best that does
    not fit 64 bits is an error. Queries meet all rows block by
    block: every block of rows is read once for each block of queries.
    """
    rows = select_into(rows.dropna().select("id", "vector"))
    asked = select_into(queries.dropna().groupBy("id").agg(F.min("vector").alias("vector")))
    n_rows, n_queries = rows.count(), asked.count()
    row_blocks, query_blocks = -(-n_rows // ROW_BLOCK) or 1, -(-n_queries // QUERY_BLOCK) or 1

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
        return df.select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias(own), every)

    def search(one: pa.Table, two: pa.Table) -> pa.Table:
        found = []
        if one.num_rows and two.num_rows:
            width = max(len(v) for t in (one, two) for v in t.column("vector").to_pylist())
            block = Block(two.column("id").to_numpy(), matrix(two.column("vector"), width))
            asked_ids, asked_vectors = one.column("id").to_numpy(), matrix(one.column("vector"), width)
            for query_id, query in zip(asked_ids, asked_vectors, strict=True):
                ids, scores = block.top(int(query_id), query, k)
                found.append((np.full(len(ids), query_id), ids, scores))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] or [np.empty(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns), strict=True)))

    left = dealt(asked, "query_block", query_blocks, "row_block", row_blocks).groupBy("query_block", "row_block")
    right = dealt(rows, "row_block", row_blocks, "query_block", query_blocks).groupBy("query_block", "row_block")
    near = left.cogroup(right).applyInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
