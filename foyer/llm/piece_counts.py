"""Token counts without token ids.

A tokenizer that splits a text into pre-tokens and codes each by itself gives a
text as many tokens as its pre-tokens have pieces in all. So every distinct
pre-token of the corpus is coded once, and documents add up the counts of theirs:

1. Each task counts its pre-tokens; their sums over all tasks are the corpus's
   pre-tokens with their frequencies, and each is coded once.
2. The most frequent short ones, at most ``HEAD`` of at most ``SHORT``
   characters, go to all tasks, which is a bounded table; a document's
   frequencies meet it where they are counted. This takes the hot pre-tokens out
   of every shuffle.
3. The rest of a document's frequencies is joined to the counts and summed.
"""

from __future__ import annotations

import json
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, pre_tokenizers

from ..operators.tables import select_into
from .common import without

RESULT = ("n_bytes", "n_tokens", "over_limit")
#: Bounds of the table that every task holds.
HEAD, SHORT = 65_536, 32
#: Distinct pre-tokens a task holds before it passes its sums on.
HELD = 300_000
#: Words whose pre-tokens a task remembers, and their longest.
REMEMBERED, LONGEST = 300_000, 40

#: Beyond these characters the tokenizer's own steps are asked, as tables of characters differ by version.
_OTHER = regex.compile(r"[^\x00-\x1b\x20-ɏ]")


class PreTokens:
    """Splits texts as a tokenizer file says, and counts the pieces of pre-tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            plan = json.load(file)
        self.whole = Tokenizer.from_str(json.dumps(plan))
        added = [t["content"] for t in plan.get("added_tokens", [])]
        plain = all(not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]) for t in plan.get("added_tokens", []))
        if not plain:
            raise ValueError("added tokens that strip or match normalised text are not supported")
        # The longest first, as where one begins with another.
        added.sort(key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pattern, self.remembered = self._pattern(plan), {}
        self.spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        bare = plan | {"normalizer": None, "pre_tokenizer": None, "post_processor": None, "added_tokens": [], "truncation": None, "padding": None}
        self.bare = Tokenizer.from_str(json.dumps(bare))

    @staticmethod
    def _pattern(plan: dict):
        """The file's pattern, if the file composes and lowers letters, lists what lies between white space, and spells it in bytes."""
        steps = [s["type"] for s in (plan.get("normalizer") or {}).get("normalizers", [])]
        parts = (plan.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if steps != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in parts] != ["Split", "ByteLevel"]:
            return None
        blank = plan["normalizer"]["normalizers"][1]
        split, spell = parts
        fits = split["invert"] and split["behavior"] == "Removed" and not spell["add_prefix_space"] and not spell["use_regex"]
        fits = fits and blank["pattern"] == {"Regex": "\\s+"} and blank["content"] == " " and "Regex" in split["pattern"]
        pattern = regex.compile(split["pattern"]["Regex"]) if fits else None
        return pattern if pattern and not pattern.search(" \t\n") else None

    def parted(self, text: str) -> tuple[list[str], list[str], int]:
        """A text's words between white space, which no pre-token crosses, other pre-tokens, and the number of its added tokens.

        Words are in lower case and still to be split by the file's pattern.
        Pre-tokens are in the spelling of the model (bytes as letters) behind
        ``b``, or in the file's pattern's own behind ``p``.
        """
        words, others, marks = [], [], 0
        parts = [text]
        if self.added is not None and self.added.search(text):
            parts, marks = self.added.split(text), len(self.added.findall(text))
        for part in parts:
            if self.pattern is not None and not _OTHER.search(part) and unicodedata.is_normalized("NFC", part):
                words.extend(part.lower().split())
            elif part:
                tidy = self.whole.normalizer.normalize_str(part) if self.whole.normalizer else part
                split = self.whole.pre_tokenizer
                others.extend(["b" + p for p, _ in split.pre_tokenize_str(tidy)] if split else ["b" + tidy])
        return words, others, marks

    def split(self, word: str) -> list[str]:
        """The pre-tokens of a word; each word is split once."""
        found = self.remembered.get(word)
        if found is None:
            found = ["p" + x for x in self.pattern.findall(word)]
            remember(self.remembered, word, found)
        return found

    def count(self, text: str) -> tuple[Counter, int]:
        """How often each pre-token occurs, and the number of added tokens in the text."""
        words, others, marks = self.parted(text)
        return self.spread(Counter(words), Counter(others)), marks

    def spread(self, words: Counter, others: Counter) -> Counter:
        """``others`` and the pre-tokens of ``words``."""
        for word, times in words.items():
            for x in self.split(word):
                others[x] += times
        return others

    def summed(self, text: str, near: dict[str, int], known: dict[str, int]) -> tuple[int, Counter]:
        """The pieces of all pre-tokens that ``near`` has, and the frequencies of the others.

        ``known`` remembers the sums of words whose pre-tokens are all in ``near``.
        """
        words, others, total = self.parted(text)
        rest = Counter()
        for word, times in Counter(words).items():
            own = known.get(word)
            if own is None:
                own, whole = 0, True
                for x in self.split(word):
                    if x in near:
                        own += near[x]
                    else:
                        rest[x] += times
                        whole = False
                if whole:
                    remember(known, word, own)
            total += times * own
        for x, times in Counter(others).items():
            if x in near:
                total += times * near[x]
            else:
                rest[x] += times
        return total, rest

    def pieces(self, words: list[str]) -> list[int]:
        """The number of pieces of each pre-token."""
        spelled = [w[1:] if w[0] == "b" else self._spelled(w[1:]) for w in words]
        return [len(e.ids) for e in self.bare.encode_batch(spelled, add_special_tokens=False)]

    def _spelled(self, word: str) -> str:
        return "".join(p for p, _ in self.spelled.pre_tokenize_str(word))


def remember(known: dict, word: str, value: object) -> None:
    """Add a word that is not too long; a full memory starts anew."""
    if len(word) <= LONGEST:
        if len(known) >= REMEMBERED:
            known.clear()
        known[word] = value


@lru_cache(maxsize=2)
def splitter(path: str) -> PreTokens:
    return PreTokens(path)


def vocabulary(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Every distinct pre-token: ``piece`` (its spelling), its frequency ``times`` and its ``pieces``."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, words, others = splitter(path), Counter(), Counter()

        def flushed() -> pa.RecordBatch:
            found = own.spread(words, others)
            columns = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
            return pa.record_batch(columns, ["piece", "times"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                more, odd, _ = own.parted(text or "")
                words.update(more)
                others.update(odd)
                if len(words) + len(others) > HELD:
                    yield flushed()
                    words.clear()
                    others.clear()
        yield flushed()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = splitter(path)
        for batch in batches:
            found = own.pieces(batch.column(0).to_pylist())
            yield pa.record_batch([*batch.columns, pa.array(found, pa.int64())], ["piece", "times", "pieces"])

    words = docs.select(F.col(f"`{text_col}`")).mapInArrow(listed, "piece string, times long")
    words = words.groupBy("piece").agg(F.sum("times").alias("times"))
    return words.mapInArrow(coded, "piece string, times long, pieces long")


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, text_col: str = "text") -> DataFrame:
    """For each row of ``docs`` its ``n_bytes``, its ``n_tokens`` and ``over_limit``, whether these are more than ``limit``.

    ``path`` is a tokenizer file. Texts are taken whole; begin and end tokens are
    not added, and an added token spelled out in a text counts as one. A null
    text is empty and has none. Rows that repeat stay apart. The text itself is
    not carried along; extra columns are, but for those named like a result
    column. Without rows the result is empty.
    """
    docs = without(docs, RESULT, keep=(text_col,))
    known = select_into(vocabulary(docs, path, text_col))
    head = known.where(F.length("piece") <= SHORT).orderBy(F.desc("times"), "piece").limit(HEAD)
    spark = docs.sparkSession
    head = spark.sparkContext.broadcast({r.piece: r.pieces for r in head.select("piece", "pieces").toLocalIterator()})

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, near, memory = splitter(path), head.value, {}
        for batch in batches:
            sums, bytes_, words, times = [], [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                text = text or ""
                total, rest = own.summed(text, near, memory)
                sums.append(total)
                bytes_.append(len(text.encode()))
                words.append(list(rest))
                times.append(list(rest.values()))
            columns = [*batch.columns[:-1], pa.array(bytes_, pa.int64()), pa.array(sums, pa.int64())]
            columns += [pa.array(words, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))]
            yield pa.record_batch(columns, [*names, "n_bytes", "near", "words", "times"])

    # Columns travel under neutral names; the written table fixes the row numbers.
    kept = [c for c in docs.columns if c.lower() != text_col.lower()]
    names = [f"c{i}" for i in range(len(kept))]
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)], F.col(f"`{text_col}`").cast("string").alias("t"))
    added = T.StructType.fromDDL("n_bytes long, near long, words array<string>, times array<long>")
    schema = T.StructType([*plain.schema.fields[:-1], *added.fields])
    rows = select_into(plain.mapInArrow(summed, schema).withColumn("row", F.monotonically_increasing_id()))
    pairs = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("piece"), F.col("w.times").alias("n"))
    far = pairs.join(known.select("piece", "pieces"), "piece").groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("far"))
    n_tokens = F.col("near") + F.coalesce("far", F.lit(0))
    counted = rows.drop("words", "times").join(far, "row", "left").withColumn("n_tokens", n_tokens)
    own = [F.col(n).alias(c) for n, c in zip(names, kept, strict=True)]
    return counted.select(*own, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
