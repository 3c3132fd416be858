"""Byte-level BPE by a local rank file: texts to token ids and back to bytes."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import without

#: Longer texts are cut into parts of about this many characters first, which
#: bounds the memory of one call and the matcher's stack.
PART_CHARS = 100_000
#: White space runs of at least this length become parts of their own.
SPACE_RUN = 10_000

#: Places where a match of the pattern always ends, whatever stands around
#: them: no match goes on from a letter to anything else, from a digit to
#: anything else, or from any visible character to white space.
SAFE = regex.compile(
    r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})|(?<=[^\p{White_Space}\p{L}\p{N}])(?=\p{White_Space})"
)
SPACES = regex.compile(r"\p{White_Space}{%d,}" % SPACE_RUN)


@lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, loaded once for each worker process."""
    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def parts(text: str) -> Iterator[str]:
    """``text`` in parts whose matches are those of the whole.

    A white space run gives up its last character to the match after it, if
    something follows, so a long run ends a part one character early.
    """
    if len(text) <= PART_CHARS:
        yield text
        return
    begin = 0
    for run in SPACES.finditer(text):
        yield from pieces(text[begin : run.start()])
        begin = run.end() if run.end() == len(text) else run.end() - 1
        yield from spaces(text[run.start() : begin])
    yield from pieces(text[begin:])


def pieces(text: str) -> Iterator[str]:
    begin = 0
    while len(text) - begin > PART_CHARS:
        cut = SAFE.search(text, begin + PART_CHARS)
        if cut is None or cut.start() >= len(text):
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    if begin < len(text):
        yield text[begin:]


def spaces(run: str) -> Iterator[bytes]:
    """A run of white space is one match; as bytes it needs no matcher."""
    if run:
        yield run.encode()


def token_ids(coder: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of a whole text, special tokens being ordinary text."""
    found = [
        np.asarray(coder._encode_single_piece(x) if isinstance(x, bytes) else coder.encode_ordinary(x), np.int32)
        for x in parts(text)
    ]
    return np.concatenate(found) if found else np.empty(0, np.int32)


def encode(
    df: DataFrame, ranks: str, pattern: str, text_col: str = "text", out: str = "token_ids"
) -> DataFrame:
    """``df`` with the token ids of ``text_col`` as an array; a null text counts as empty.

    ``ranks`` is the path of a rank file that every executor can open.
    """

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoding(ranks, pattern)
        for texts in batches:
            ids = [token_ids(coder, text or "") for text in texts.to_pylist()]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return without(df, [out], keep=[text_col]).withColumn(out, run(F.col(f"`{text_col}`")))


def decode(
    df: DataFrame, ranks: str, pattern: str, ids_col: str = "token_ids", out: str = "decoded"
) -> DataFrame:
    """``df`` with the raw bytes that the ids stand for.

    The bytes need not be valid text where ids were cut. Null for a null array,
    or one that holds a null or an id the rank file lacks.
    """

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoding(ranks, pattern)
        for rows in batches:
            yield pa.array([bytes_of(coder, ids) for ids in rows.to_pylist()], pa.binary())

    return without(df, [out], keep=[ids_col]).withColumn(out, run(F.col(f"`{ids_col}`")))


def bytes_of(coder: tiktoken.Encoding, ids: list[int | None] | None) -> bytes | None:
    if ids is None:
        return None
    try:
        return coder.decode_bytes(ids)
    except (KeyError, TypeError, OverflowError):
        return None
