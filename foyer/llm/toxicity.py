"""Toxicity: a linear classifier that is penalised for reacting to identity terms.

Words and word beginnings, hashed to numbers, are the features. Beside the loss
on labelled rows the fit pays for each pair of a labelled text and the same text
with an identity term swapped for another one: the squared difference of their
scores. A neutral mention of a group then cannot carry the label.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import without

RESULT = ("score", "predicted")
#: Labelled rows of each class that the fit may use at most, lowest hash of the id first.
FIT_ROWS = 4_000
#: Feature numbers; features that hash to one number share its weight.
NUMBERS = 1 << 18
#: Lengths of the word beginnings that are features.
BEGINNINGS = (3, 4, 5, 6)
#: Words whose feature numbers a task remembers.
REMEMBERED = 200_000

# Terms that name groups of people, in sets within which one may stand for another.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "lesbian", "bisexual", "transgender", "straight", "queer"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("deaf", "blind", "disabled", "elderly", "young"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)

WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    """A word's features: itself, marked by its end, and its beginnings."""
    return [f"{word}$", *[word[:n] for n in BEGINNINGS if len(word) >= n]]


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


class Numbers(dict):
    """The feature numbers of words, remembered for a bounded number of words."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        own = tuple(zlib.crc32(f.encode()) % NUMBERS for f in word_features(word))
        self[word] = own
        return own

    def of(self, words: set[str]) -> np.ndarray:
        """The different feature numbers of some words, ascending."""
        return np.unique(np.fromiter(chain.from_iterable(self[w] for w in words), np.int32))


@dataclass
class Model:
    """Weights by feature number and a bias; without weights every text gets the bias."""

    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(NUMBERS))

    def score(self, text: str | None, numbers: Numbers | None = None) -> float:
        present = (Numbers() if numbers is None else numbers).of(words_of(text))
        total = self.bias + self.weights[present].sum()
        return float(1.0 / (1.0 + np.exp(-np.clip(total, -500.0, 500.0))))


def labelled_rows(
    docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str, text_col: str, label_col: str, fit_rows: int
) -> tuple[DataFrame, dict[int, int]]:
    """Texts and labels of at most ``fit_rows`` rows for each class, and the rows of each class there are."""
    own = F.col(f"`{id_col}`")
    given = labels.select(own.alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    given = given.where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & allowed)
    counts = {r[0]: r[1] for r in given.groupBy("label").count().collect()}
    # At most fit_rows ids of either class, which bounds what is broadcast; tasks pass on no more than that.
    first = [given.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(fit_rows) for c in (0, 1)]
    chosen = first[0].union(first[1])
    texts = docs.select(own.alias("id"), F.col(f"`{text_col}`").alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("text", "label"), counts


def feature_rows(rows: DataFrame) -> tuple[list[np.ndarray], list[int], list[np.ndarray]]:
    """Of each labelled row the feature numbers and the label; of its swapped twins the changes in features.

    A change lists the numbers of features that come as themselves and of those
    that go as their complement. Rows come in an order of their values, so that a
    rerun adds up in the same order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        for batch in batches:
            own, labels, swaps = [], [], []
            for text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                now = numbers.of(words)
                twins = []
                for group in IDENTITY_TERMS:
                    for term in sorted(words.intersection(group)):
                        other = group[(group.index(term) + 1) % len(group)]
                        then = numbers.of((words - {term}) | {other})
                        change = np.concatenate([np.setdiff1d(then, now), ~np.setdiff1d(now, then)])
                        twins.append(change.astype(np.int32).tobytes())
                own.append(now.tobytes())
                labels.append(label)
                swaps.append(twins)
            kinds = (pa.binary(), pa.int32(), pa.list_(pa.binary()))
            columns = [pa.array(x, k) for x, k in zip((own, labels, swaps), kinds, strict=True)]
            yield pa.record_batch(columns, ["own", "label", "swaps"])

    found = rows.mapInArrow(run, "own binary, label int, swaps array<binary>").collect()
    found.sort(key=lambda r: (r.label, bytes(r.own)))
    own = [np.frombuffer(r.own, np.int32) for r in found]
    return own, [r.label for r in found], [np.frombuffer(x, np.int32) for r in found for x in r.swaps if x]


def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value of every entry."""
    at = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    return at, np.concatenate(rows) if rows else np.empty(0, np.int32)


def evidence(at: np.ndarray, feature: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each feature number the squared difference of its shares in the classes in standard errors, the largest as one."""
    n1 = y.sum()
    n0 = len(y) - n1
    one = np.bincount(feature, y[at], NUMBERS)
    both = np.bincount(feature, minlength=NUMBERS)
    share = (both + 1) / (n0 + n1 + 2)
    z = (one / n1 - (both - one) / n0) / np.sqrt(share * (1 - share))
    return z**2 / max(1e-12, (z**2).max())


def descend(
    own: list[np.ndarray], labels: Sequence[int], swaps: list[np.ndarray], counts: dict[int, int],
    steps: int, ridge: float, fairness: float, missed: float,
) -> tuple[np.ndarray, float]:
    """Weights and bias at the least loss, by gradient steps of adapted length.

    Rows weigh as many rows of their class as there are for each that was drawn,
    those of class 1 ``missed`` times that. A feature's weight is a factor times
    its evidence, and the ridge term is on the factors: the less the classes
    differ in a feature, the dearer its weight, and none is left out.
    """
    y = np.array(labels, float)
    at, feature = flat(own)
    swap_at, changed = flat(swaps)
    sign, swapped = np.where(changed >= 0, 1.0, -1.0), np.where(changed >= 0, changed, ~changed)
    weight = np.array([counts[c] / max(1, labels.count(c)) for c in (0, 1)]) * (1.0, missed)
    weight = weight[np.array(labels)]
    weight = weight / weight.sum()
    scale = evidence(at, feature, y)
    w, first, second = (np.zeros(NUMBERS + 1) for _ in range(3))
    for step in range(1, steps + 1):
        scaled = w[:NUMBERS] * scale
        p = 1.0 / (1.0 + np.exp(-np.clip(np.bincount(at, scaled[feature], len(own)) + w[NUMBERS], -500, 500)))
        error = (p - y) * weight
        slope = np.bincount(feature, error[at], NUMBERS)
        if len(swaps):
            gap = np.bincount(swap_at, sign * scaled[swapped], len(swaps))
            slope += 2 * fairness / len(swaps) * np.bincount(swapped, sign * gap[swap_at], NUMBERS)
        slope = np.append(slope * scale + ridge * w[:NUMBERS], error.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        w = w - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:NUMBERS] * scale, float(w[NUMBERS])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    allowed: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    fit_rows: int = FIT_ROWS,
    steps: int = 200,
    ridge: float = 1e-6,
    fairness: float = 1.0,
    missed: float = 2.0,
) -> Model:
    """A model from labelled texts; ``allowed`` is a condition on the labels' column ``id``.

    Labels other than 0 and 1 and rows without id teach nothing; a row that is
    there twice counts twice. A missed toxic row costs ``missed`` times as much as a
    clean row that is rejected. With one class, or none, every text gets the share
    of label 1, with half a row added to each class and one more to class 0.
    The feature numbers of at most ``fit_rows`` rows of either class come to the driver.
    """
    allowed = F.lit(True) if allowed is None else allowed
    rows, counts = labelled_rows(docs, labels, allowed, id_col, text_col, label_col, fit_rows)
    own, given, swaps = feature_rows(rows)
    if len(set(given)) < 2:
        share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 2.0)
        return Model(float(np.log(share / (1 - share))))
    weights, bias = descend(own, given, swaps, counts, steps, ridge, fairness, missed)
    return Model(bias, weights)


def classify(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with ``score`` from 0 to 1 and ``predicted``, 1 from a score of 0.5.

    A null or empty text gets the score of a text without known features. Extra
    columns pass through, but for those named like a result column.
    """

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        numbers = Numbers()
        for texts in batches:
            yield pa.array([model.score(t, numbers) for t in texts.to_pylist()], pa.float64())

    df = without(df, RESULT, keep=[text_col])
    out = df.withColumn("score", run(F.col(f"`{text_col}`")))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
