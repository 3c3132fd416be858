"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import without

RESULT = ("lang_pred", "score")
#: N-grams of a profile, of a language and of a document alike.
TOP = 400
#: Texts are counted in parts of this many characters, which bounds memory.
PART_CHARS = 500_000
#: Counts a task holds before it passes them on.
FLUSH = 2_000_000
UNKNOWN = "und"

#: Three code points of 21 bits make one 63-bit key; this one, no letter, stands for a word's edge.
BITS, EDGE = np.uint64(21), 1


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether a code point is a letter, for all code points."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The 1- to 3-grams of a text's words, lower-cased and with their edges, and their counts."""
    found, text = [], f" {text.lower()}  "
    for at in range(0, len(text) - 2, PART_CHARS):
        # Each character stands once in the middle of three, also between parts.
        codes = np.frombuffer(text[at : at + PART_CHARS + 2].encode("utf-32-le"), "<u4")
        codes = np.where(letters()[codes], codes, EDGE).astype(np.uint64)
        a, b, c = codes[:-2], codes[1:-1], codes[2:]
        keys = np.concatenate([b[b > EDGE], (a << BITS | b)[(a | b) > EDGE], ((a << BITS | b) << BITS | c)[b > EDGE]])
        found.append(np.unique(keys, return_counts=True))
    return merged(found)


def merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sums of several counts by key."""
    if len(found) == 1:
        return found[0]
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    counts = np.bincount(at, np.concatenate([n for _, n in found]), len(keys))
    return keys, counts.astype(np.int64)


def ranked(keys: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent keys, most frequent first, ties by key."""
    if len(keys) > top:
        low = -np.partition(-counts, top - 1)[top - 1]
        keys, counts = keys[counts >= low], counts[counts >= low]
    return keys[np.lexsort((keys, -counts))[:top]]


def profiles(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = TOP) -> dict:
    """The ranked n-grams of each language over all labelled rows.

    Rows without language or text teach nothing. Tasks count their own rows and
    pass on sums; ``top`` keys for each language come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, found in held.items():
                keys, counts = merged(found)
                yield pa.record_batch(
                    [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts)],
                    ["lang", "gram", "n"],
                )
            held.clear()

        for batch in batches:
            texts: dict[str, list[str]] = {}
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                texts.setdefault(lang, []).append(text)
            for lang, some in texts.items():
                found = held.setdefault(lang, [])
                found.append(grams("\n".join(some)))
                if len(found) > 20:
                    found[:] = [merged(found)]
            if sum(len(k) for found in held.values() for k, _ in found) > FLUSH:
                yield from flush()
        yield from flush()

    rows = labelled.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    counted = rows.dropna().mapInArrow(count, "lang string, gram long, n long")
    summed = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    chosen = summed.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    found: dict[str, list] = {}
    for lang, gram, rank in chosen.select("lang", "gram", "rank").collect():
        found.setdefault(lang, []).append((rank, gram))
    return {lang: np.array([g for _, g in sorted(found[lang])], np.uint64) for lang in sorted(found)}


class Profiles:
    """Profiles laid out for look-up: keys in order, beside each its rank."""

    def __init__(self, ranks: dict[str, np.ndarray], top: int = TOP):
        self.names, self.top = list(ranks), top
        self.keys = [np.sort(k) for k in ranks.values()]
        self.ranks = [np.argsort(k) for k in ranks.values()]

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language at the least out-of-place distance, and one minus that distance over the largest possible."""
        own = ranked(*grams(text), self.top) if text else np.empty(0, np.uint64)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        place, best = np.arange(len(own)), (2.0, UNKNOWN)
        for name, keys, ranks in zip(self.names, self.keys, self.ranks, strict=True):
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            far = np.where(keys[at] == own, np.minimum(np.abs(ranks[at] - place), self.top), self.top)
            best = min(best, (far.sum() / (self.top * len(own)), name))
        return best[1], 1.0 - best[0]


def identify(df: DataFrame, ranks: dict[str, np.ndarray], text_col: str = "text", top: int = TOP) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` from 0 to 1.

    A null text, or one without a letter, is ``und`` with score 0, and so is
    every text where no language was learned. Of languages at the same distance
    the first by name is taken. Extra columns pass through, but for those named
    like a result column.
    """
    known = Profiles(ranks, top)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [known.predict(t) for t in texts.to_pylist()]
            names = pa.array([x for x, _ in found], pa.string())
            yield pa.StructArray.from_arrays([names, pa.array([x for _, x in found], pa.float64())], list(RESULT))

    df = without(df, RESULT, keep=[text_col])
    out = df.withColumn("lang_pred", run(F.col(f"`{text_col}`")))
    return out.withColumns({"score": F.col("lang_pred.score"), "lang_pred": F.col("lang_pred.lang_pred")})
