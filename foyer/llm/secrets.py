"""Secrets in texts: fixed patterns, and character Markov models for the rest.

Two first-order models are trained from labelled samples, one on random strings
and one on ordinary identifiers. A long token outside the patterns' spans is a
secret where the first explains it so much better that the log-likelihood ratio
passes a threshold. Everything runs in Spark's own expressions.
"""

from __future__ import annotations

import string
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, without

RESULT = ("n_assign", "n_access", "n_hex", "base_sha256", "spans")

# The patterns of the base kinds, in the order of their kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Least length of an assigned value.
ASSIGNED = 8

KINDS = ("assign", "access", "hex", "random")
#: What the models are asked about: runs of these characters, of at least this length.
SYMBOLS = string.ascii_letters + string.digits + "+/_=-"
TOKEN = "[A-Za-z0-9+/_=-]{%d,}"
LEAST = 20
#: Log-likelihood ratio from which a token is a secret.
THRESHOLD = 20.0
#: The ratio for each character that it must reach as well: long runs of little surprise are no secrets.
EACH = 0.7
#: Matches whose places are summed up at once, and characters of a stretch in which spans are compared.
CHUNK, STRETCH = 256, 4096
#: Documents whose tokens train the models at most, lowest hash of the id first.
SAMPLE_DOCS = 2_000

# Labelled samples of ordinary identifiers, in the ways programs, paths and rules are written.
IDENTIFIERS = (
    "getOrCreateSession createTemporaryView shufflePartitions maximumRowsPerBatch userAccountManager parseConfigurationFile "
    "HttpServletRequest DataFrameWriter InvalidArgumentException AbstractSingletonProxyFactoryBean XMLHttpRequest JSONObject "
    "toLowerCase isNullOrEmpty onClickListener setRequestHeader updateUserPreferences QuickSortJoinBuffer lazyValueFixture "
    "max_number_of_connections average_response_time user_name_and_password_file date_of_birth created_at updated_by "
    "query_execution_plan_cache zone_type_index job_queue_size previous_object_key MAX_RETRY_COUNT DEFAULT_TIMEOUT_SECONDS "
    "PYTHONPATH JAVA_HOME ENABLE_VERBOSE_LOGGING NUMBER_OF_EXECUTORS HTTP_PROXY_HOST KEYBOARD_LAYOUT_JAPANESE "
    "data-processing-pipeline content-security-policy x-forwarded-for my-project-name border-bottom-width jquery-plugin-utils "
    "usr/local/lib/python3/site-packages home/user/documents/projects src/main/java/org/example/service/impl var/log/syslog "
    "static/images/background/header tests/unit/test_configuration_loader etc/nginx/sites-available wp-content/themes/index "
    "2024-01-31T12-30-00 20231231 version-1-2-3 2001-09-09 1234567890 0000000000000000 ---------------- ================ "
    "________________ aaaaaaaaaaaaaaaa xxxxxxxxxxxxxxxx ++++++++++++++++ //////////////// key=value&page=2 a=1 lang=en"
).split()


SPAN = "array<struct<start:int,kind:int,end:int,token:string>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: inside a lambda any other expression is computed for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def matched(text: Column, pattern: str, kind: int, least_value: int | None = None) -> Column:
    """The matches of a pattern as an array of (start, kind, end, token), in code points.

    The text between matches gives their places: lengths are summed up inside
    chunks of ``CHUNK`` matches and then over the chunks, as a fold copies what it
    has gathered at every step. With ``least_value`` matches whose second group is
    shorter are dropped after matching.
    """
    whole, between = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)
    value = F.regexp_extract_all(text, F.lit(pattern), 2 if least_value else 0)
    steps = F.zip_with(between, whole, lambda b, w: F.struct(F.length(b).alias("gap"), F.length(w).alias("size")))
    steps = F.zip_with(steps, value, lambda s, v: F.struct(s["gap"].alias("gap"), s["size"].alias("size"), v.alias("token")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def step(seen: Column, one: Column) -> Column:
        begin = seen["at"] + one["gap"]
        end = begin + one["size"]
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), one["token"].alias("token"))
        good = F.length(one["token"]) >= (least_value or 0)
        return F.struct(end.alias("at"), F.when(good, F.concat(seen["found"], F.array(span))).otherwise(seen["found"]).alias("found"))

    def moved(chunk: Column, by: Column) -> Column:
        return F.transform(
            chunk["found"],
            lambda s: F.struct((s["start"] + by).alias("start"), s["kind"].alias("kind"), (s["end"] + by).alias("end"), s["token"].alias("token")),
        )

    def all_of(chunks: Column) -> Column:
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("before"))
        add = lambda seen, c: F.struct((seen["at"] + c["at"]).alias("at"), F.concat(seen["before"], F.array(seen["at"])).alias("before"))
        return F.flatten(F.zip_with(chunks, F.aggregate(chunks, none, add)["before"], moved))

    # The last gap has no match after it.
    def in_chunks(steps: Column) -> Column:
        last = F.floor((F.size(steps) - 2) / CHUNK).cast("int")
        each = lambda k: F.aggregate(F.slice(steps, k * CHUNK + 1, F.least(F.lit(CHUNK), F.size(steps) - 1 - k * CHUNK)), start, step)
        return let(F.transform(F.sequence(F.lit(0), last), each), all_of)

    return F.when(text.rlike(pattern), let(steps, in_chunks)).otherwise(F.array().cast(SPAN))


def overlapping(spans: Column, others: Column, length: Column) -> Column:
    """For each of ``spans`` whether one of ``others`` shares a character with it; both lists are sorted and free of overlaps of their own kind.

    The others are listed by the stretches of ``STRETCH`` characters that they touch, so a span is
    compared with those of its own stretches only.
    """
    last = F.floor(length / STRETCH).cast("int")
    touches = lambda k: lambda o: (o["start"] < (k + 1) * STRETCH) & (o["end"] > k * STRETCH)
    listed = F.transform(F.sequence(F.lit(0), last), lambda k: F.filter(others, touches(k)))

    def with_lists(lists: Column) -> Column:
        def hit(span: Column) -> Column:
            own = F.sequence(F.floor(span["start"] / STRETCH).cast("int"), F.floor((span["end"] - 1) / STRETCH).cast("int"))
            return F.exists(own, lambda k: F.exists(F.get(lists, k), lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"])))

        return F.transform(spans, hit)

    return let(listed, with_lists)


def base_spans(text: Column) -> Column:
    """The spans of the three base kinds, by start and then kind."""
    found = F.concat(matched(text, ASSIGN, 0, ASSIGNED), matched(text, ACCESS, 1), matched(text, HEX, 2))
    return F.array_sort(found)


def samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Labelled tokens (``token``, ``secret``) from the documents of at most ``sample_docs`` ids.

    Secrets are what the base patterns find in the sampled texts, and digests of
    the sampled ids in the alphabets that keys are written in. Identifiers are
    the long tokens of the sampled texts outside those spans, and ``IDENTIFIERS``.
    """
    own, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    # Only ids are ordered; as many as the parameter says go back to the texts.
    chosen = docs.select(own.alias("chosen")).orderBy(F.xxhash64("chosen"), "chosen").limit(sample_docs).distinct()
    rows = docs.select(own.alias("id"), text.alias("text"))
    some = rows.join(F.broadcast(chosen), rows["id"].eqNullSafe(chosen["chosen"]), "left_semi")
    digest = F.sha2(F.coalesce(F.col("id").cast("string"), F.lit("")), 512)
    code = F.base64(F.unhex(digest))
    made = F.array(
        F.substring(digest, 1, 40),
        F.substring(F.regexp_replace(code, "[+/=]", ""), 1, 40),
        F.substring(code, 1, 40),
        F.substring(F.regexp_replace(F.upper(code), "[+/=]", ""), 1, 20),
    )
    known = F.transform(base_spans(F.col("text")), lambda s: s["token"])
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    plain = F.regexp_extract_all(rest, F.lit(TOKEN % 6), 0)
    usual = docs.sparkSession.createDataFrame([(t, False) for t in IDENTIFIERS], "token string, secret boolean")
    secret = some.select(F.explode(F.concat(made, known)).alias("token"), F.lit(True).alias("secret"))
    return secret.union(some.select(F.explode(plain).alias("token"), F.lit(False).alias("secret"))).union(usual)


def codes() -> np.ndarray:
    """The number of each ASCII character among the symbols, 0 for others and for the start."""
    out = np.zeros(128, np.int32)
    for at, symbol in enumerate(SYMBOLS):
        out[ord(symbol)] = at + 1
    return out


def steps_of(token: Column) -> Column:
    """A token's transitions, as numbers of (before, after) pairs of symbols."""
    number = F.lit(codes())
    one = lambda c: F.coalesce(F.get(number, F.ascii(c)), F.lit(0))
    after = F.transform(F.split(token, ""), one)
    before = F.concat(F.array(F.lit(0)), F.slice(after, 1, F.greatest(F.size(after) - 1, F.lit(0))))
    # Two whole arrays side by side: one looked up in a lambda would be built again for each element.
    return F.zip_with(before, after, lambda b, a: b * (len(SYMBOLS) + 1) + a)


def train(labelled: DataFrame, smoothing: float = 0.5) -> np.ndarray:
    """The log-likelihood ratio of each transition, random over ordinary.

    ``labelled`` has ``token`` and ``secret``; rows with a null teach nothing.
    Transitions are counted by Spark; at most two numbers for each pair of
    symbols come to the driver. Without samples every ratio is zero.
    """
    size = len(SYMBOLS) + 1
    rows = labelled.dropna(subset=["token", "secret"]).where(F.length("token") > 0)
    counts = np.full((2, size, size), smoothing)
    steps = rows.select("secret", F.explode(steps_of(F.col("token"))).alias("step"))
    for secret, step, n in steps.groupBy("secret", "step").count().collect():
        counts[int(secret), step // size, step % size] += n
    share = counts / counts.sum(axis=2, keepdims=True)
    return np.log(share[1] / share[0]).ravel()


def scan(
    docs: DataFrame,
    ratios: np.ndarray,
    text_col: str = "text",
    least: int = LEAST,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with ``secrets``, an array of (start, kind, end, token) by start and kind.

    Places are code points, ends exclusive; kinds are numbers in ``KINDS``. A null
    text counts as empty. Spans of the models do not meet those of the patterns; their tokens reach the
    ``threshold`` as a whole and ``EACH`` for each character.
    Extra columns pass through, but for those named like a result column.
    """
    docs = without(docs, ["secrets"], keep=[text_col])
    text, base, open_ = (free_name(docs, x) for x in ("whole_text", "base_spans", "open_spans"))
    value = F.lit(ratios)

    def surprising(span: Column) -> Column:
        total = F.aggregate(steps_of(span["token"]), F.lit(0.0), lambda x, s: x + F.get(value, s))
        return total >= F.greatest(F.lit(threshold), EACH * F.length(span["token"]))

    found = docs.withColumn(text, F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    found = found.withColumn(base, base_spans(F.col(text))).withColumn(open_, matched(F.col(text), TOKEN % least, 3))
    met = overlapping(F.col(open_), F.col(base), F.length(text))
    free = F.when((F.size(base) == 0) | (F.size(open_) == 0), F.col(open_)).otherwise(
        F.transform(F.filter(F.arrays_zip(F.col(open_).alias("span"), met.alias("met")), lambda x: ~x["met"]), lambda x: x["span"])
    )
    more = F.filter(free, surprising)
    return found.withColumn("secrets", F.array_sort(F.concat(F.col(base), more))).drop(text, base, open_)


def digest(found: DataFrame) -> DataFrame:
    """``found`` with the counts of the base kinds, the digest of the base spans, and all spans as text."""
    names = F.lit(np.array(KINDS))
    line = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.transform(F.filter("secrets", lambda s: s["kind"] < 3), line)
    return found.withColumns(
        {
            **{f"n_{KINDS[k]}": of(k) for k in range(3)},
            "base_sha256": F.sha2(F.array_join(base, ","), 256),
            "spans": F.array_join(F.transform("secrets", line), ","),
        }
    )
