"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

#: Hex digits of the digest that make the uniform number: 52 bits, so a double holds it exactly.
DIGITS = 13
#: Largest mean of one draw; a larger mean is the sum of several draws, as sums of Poisson counts are Poisson counts.
DRAW_MEAN = 64.0


def uniform(key: Column, seed: str, draw: Column | None = None) -> Column:
    """A number in [0, 1) fixed by the key, the seed and, of several draws, the number of the draw."""
    prefix = F.lit(f"{seed}:") if draw is None else F.concat(F.lit(f"{seed}#"), draw.cast("string"), F.lit(":"))
    digest = F.md5(F.concat(prefix, F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long") / F.lit(2.0 ** (4 * DIGITS))


def rates(docs: DataFrame, targets: Mapping[str, float], epochs: float, source_col: str, text_col: str) -> dict:
    """The mean number of repetitions for each listed source, and under None for all others.

    Sizes are characters, counted over all rows. Listed sources get their share
    of ``epochs`` times the whole; other sources, a null one included, share what
    the targets leave in proportion to their sizes. A listed source without text
    gets nothing, and shares are scaled up to make good for it. At most one row
    for each listed source comes to the driver.
    """
    if any(w < 0 or not math.isfinite(w) for w in targets.values()) or sum(targets.values()) > 1 + 1e-9:
        raise ValueError("targets must be shares of one")
    known = F.when(F.col(f"`{source_col}`").isin(list(targets)), F.col(f"`{source_col}`"))
    size = F.coalesce(F.length(F.col(f"`{text_col}`")), F.lit(0)).cast("long")
    sizes = {r[0]: r[1] for r in docs.groupBy(known).agg(F.sum(size)).collect() if r[1]}
    shares = {s: float(w) for s, w in targets.items() if s in sizes}
    if None in sizes:
        shares[None] = max(0.0, 1.0 - sum(targets.values()))
    whole, given = float(sum(sizes.values())), sum(shares.values())
    found = {s: epochs * w / given * whole / sizes[s] for s, w in shares.items()} if given else {}
    return dict.fromkeys([None, *targets], 0.0) | found


def poisson_cdf(rate: float) -> list[float]:
    """P(count <= k) for k = 0, 1, ... up to where a double no longer tells it from one."""
    k, log_rate, total, out = 0, math.log(rate) if rate > 0 else 0.0, 0.0, []
    if rate <= 0:
        return [1.0]
    while True:
        total += math.exp(k * log_rate - rate - math.lgamma(k + 1))
        out.append(min(total, 1.0))
        if k > rate and (1.0 - total < 2.0 ** -(4 * DIGITS + 1) or k > rate + 40 * math.sqrt(rate) + 100):
            return out
        k += 1


def replicate(
    docs: DataFrame,
    targets: Mapping[str, float],
    epochs: float = 1.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    copy_col: str = "copy",
) -> DataFrame:
    """``docs`` with each row repeated by a Poisson count, in a global random order.

    The count inverts the Poisson distribution whose mean is the repetition rate
    of the row's source at a uniform number made from id and seed, so a rerun
    gives the same rows. A mean above ``DRAW_MEAN`` is split into equal draws of at
    most that, each at a uniform number of its own. ``copy_col`` numbers the copies from 1. Rows with count
    zero leave. A null id counts as empty text; rows that repeat an id get the
    same count. A column named like ``copy_col`` is replaced.
    """
    rate = rates(docs, targets, epochs, source_col, text_col)
    name, u, order = (free_name(docs, x) for x in ("count", "uniform", "order"))
    own, source = F.col(f"`{id_col}`"), F.col(f"`{source_col}`")

    def count(mean: float) -> Column:
        draws = max(1, math.ceil(mean / DRAW_MEAN))
        steps = F.array(*[F.lit(x) for x in poisson_cdf(mean / draws)])

        def passed(at: Column) -> Column:
            return F.size(F.filter(steps, lambda p: p <= at))

        if draws == 1:
            return passed(F.col(u))
        numbers = F.transform(F.sequence(F.lit(0), F.lit(draws - 1)), lambda draw: uniform(own, seed, draw))
        return F.aggregate(numbers, F.lit(0), lambda n, at: n + passed(at))

    n = count(rate[None])
    for s in targets:
        n = F.when(source.eqNullSafe(F.lit(s)), count(rate[s])).otherwise(n)
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() != copy_col.lower()]
    copies = (
        docs.withColumn(u, uniform(own, seed))
        .withColumn(name, n)
        .where(F.col(name) > 0)
        .select(*keep, F.explode(F.sequence(F.lit(1), F.col(name))).alias(copy_col))
    )
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(own.cast("string"), F.lit("")), F.col(copy_col)).cast("binary"))
    shuffled = copies.withColumn(order, key).repartition(F.col(order)).sortWithinPartitions(order)
    return shuffled.drop(order)
