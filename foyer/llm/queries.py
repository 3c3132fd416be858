"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, exact, hard_negatives, html_text, langid, licenses, merkle, mixing, neardup, piece_counts, secrets, topk, toxicity,
)
from .common import fold, lower_ascii, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: Where the rank file is, and its pattern.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: A tokenizer file to count tokens by.
WORD_PIECES = public_tokenizers.path("word_bpe_49k.json")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLE_SQL[run.__name__] = sql
        return run

    return add


#: A-Z lowered, in DuckDB.
NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query()
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN)
    decimal = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query(
    f"""
WITH d AS (SELECT doc_id, sha256({NORM}) AS text_sha256, {NORM} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g ON d.norm = g.norm"""
)
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    marked = exact.mark_copies(table(spark, folder, "documents").select("doc_id", "text"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


#: Shares of the mix; sources that are not listed share the rest by size.
TARGETS = {"src0": 0.10, "src1": 0.10, "src2": 0.08, "src3": 0.02}


def _mix_sql(docs: str, targets: dict[str, float]) -> str:
    """DuckDB SQL for ``mixing.replicate`` over ``docs`` with one epoch and the seed ``mix``."""
    listed = ", ".join(f"('{s}', CAST({w!r} AS DOUBLE))" for s, w in targets.items())
    rest, most = repr(max(0.0, 1.0 - sum(targets.values()))), repr(mixing.DRAW_MEAN)
    return f"""
target(source, share) AS (VALUES {listed}),
doc AS (SELECT d.*, t.source AS listed FROM {docs} d LEFT JOIN target t ON d.source = t.source),
volume AS (SELECT listed, sum(coalesce(length(text), 0)) AS chars FROM doc GROUP BY listed HAVING chars > 0),
given AS (SELECT v.listed, CAST(v.chars AS DOUBLE) AS chars, coalesce(t.share, {rest}) AS share
  FROM volume v LEFT JOIN target t ON v.listed = t.source),
rate AS (SELECT listed, share / (SELECT sum(share) FROM given) * (SELECT sum(chars) FROM given) / chars AS whole FROM given),
draw AS (SELECT listed, CAST(greatest(1, ceil(whole / {most})) AS BIGINT) AS draws, whole / draws AS mean FROM rate WHERE whole > 0),
step AS (SELECT listed, draws, k, sum(exp(k * ln(mean) - mean - lgamma(k + 1)))
    OVER (PARTITION BY listed ORDER BY k) AS p
  FROM draw, range(0, CAST({most} + 20 * sqrt({most}) + 41 AS BIGINT)) r(k) WHERE k <= mean + 20 * sqrt(mean) + 40),
steps AS (SELECT listed, draws, list(p) AS ps FROM step GROUP BY listed, draws),
drawn AS (SELECT d.*, s.ps, list_transform(range(0, s.draws), lambda j:
    CAST('0x' || substr(md5('mix' || CASE WHEN s.draws = 1 THEN '' ELSE '#' || j END || ':' || coalesce(CAST(doc_id AS VARCHAR), '')),
      1, 13) AS BIGINT) / 4503599627370496.0) AS us
  FROM doc d LEFT JOIN steps s ON s.listed IS NOT DISTINCT FROM d.listed),
times AS (SELECT *, coalesce(list_sum(list_transform(us, lambda u: len(list_filter(ps, lambda p: p <= u)))), 0) AS n FROM drawn),
copies AS (SELECT doc_id, text, lang, source, n_chars, CAST(unnest(range(1, CAST(n AS BIGINT) + 1)) AS INTEGER) AS copy FROM times)"""


@query(f"WITH {_mix_sql('documents', TARGETS)}\nSELECT * FROM copies")
def op7_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.replicate(table(spark, folder, "documents"), TARGETS)


@query()
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    held_out = fold(F.col("doc_id"), 4) == 2
    known = langid.profiles(docs.where(~F.coalesce(held_out, F.lit(False))))
    found = langid.identify(docs, known)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query()
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, folder, "labels"), fold(F.col("id"), 5) != 0)
    found = toxicity.classify(docs, model)
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def _words_sql(text: str) -> str:
    plain = f"trim(lower(regexp_replace({text}, '[^A-Za-z0-9]+', ' ', 'g')))"
    return f"CASE WHEN {plain} = '' THEN [] ELSE string_split({plain}, ' ') END"


def _bigrams_sql(words: str) -> str:
    pairs = f"list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1])"
    return f"CASE WHEN len({words}) > 1 THEN list_distinct({pairs}) ELSE {words} END"


def _licenses_sql() -> str:
    quoted = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in licenses.TEMPLATES.items())
    return f"""
WITH body(license, body) AS (VALUES {quoted}),
bw AS (SELECT license, {_words_sql("body")} AS w FROM body),
bg AS (SELECT license, {_bigrams_sql("w")} AS g FROM bw),
tg AS (SELECT license, len(g) AS t, unnest(g) AS gram FROM bg),
seg AS (SELECT DISTINCT doc_id, part FROM (SELECT doc_id, unnest(list_concat([text], regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'),
  string_split(text, chr(10)))) AS part FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL)),
sw AS (SELECT doc_id, sha256(part) AS part_sha, {_words_sql("part")} AS w FROM seg),
sg AS (SELECT doc_id, part_sha, {_bigrams_sql("w")} AS g FROM sw),
sx AS (SELECT doc_id, part_sha, len(g) AS s, unnest(g) AS gram FROM sg),
m AS (SELECT doc_id, license, part_sha, 2.0 * CAST(count(*) AS DOUBLE) / (s + t) AS dice
  FROM sx JOIN tg ON sx.gram = tg.gram GROUP BY doc_id, license, part_sha, s, t),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, license, part_sha) AS k,
  count(*) OVER (PARTITION BY doc_id) AS n FROM m WHERE dice >= {licenses.LEAST_DICE})
SELECT d.doc_id, r.license, r.dice, r.part_sha AS segment, coalesce(r.n, 0) AS n_matches
FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id AND r.k = 1"""


@query(_licenses_sql())
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "license", "dice", "segment", "n_matches")


@query()
def op3_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    marked = neardup.mark_near_copies(table(spark, folder, "documents").select("doc_id", "text"))
    return marked.select("doc_id", "n_shingles", "component_id", "kept")


@query(
    """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5"""
)
def op8_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    rows = vectors.select(F.col("vec_id").alias("id"), topk.quantised(F.col("embedding")).alias("vector"))
    return topk.top_k(rows, rows.where(F.col("id") % 50 == 0), 5)


@query()
def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = html_text.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", "n_chars")


@query()
def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.digest(secrets.scan(docs, secrets.train(secrets.samples(docs))))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query()
def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return piece_counts.count_tokens(docs, WORD_PIECES).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query(
    """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM s WHERE same),
n AS (SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s ON p.place <= 5 AND s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""
)
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select(
        F.col("vec_id").alias("id"), label.alias("label"), hard_negatives.whole_numbers(F.col("embedding")).alias("vector")
    )
    return hard_negatives.mine(rows, rows.where(F.col("id") % 100 == 0))


def _leaf_sql(text: str) -> str:
    fields = [f"CAST({f} AS VARCHAR)" for f in ("doc_id", "source", "lang", "n_chars")] + [text]
    return f"sha256({' || '.join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}) || ':' || {f} END" for f in fields)})"


def _grown_sql(name: str, start: str) -> str:
    """All nodes of a tree in each group: from its leaves ``start`` (``grp``, ``idx``, ``h``) up to one node."""
    return f"""
{name}(grp, level, idx, h, n) AS (
  SELECT grp, 0, CAST(idx AS BIGINT), h, count(*) OVER (PARTITION BY grp) FROM {start}
  UNION ALL
  SELECT grp, level + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (n + 7) // 8 FROM {name}
  WHERE n > 1 GROUP BY grp, level, idx // 8, n)"""


def _walked_sql(name: str, tree: str, start: str) -> str:
    """The path of each row of ``start`` (``row``, ``grp``, ``idx``, ``found``) upward: at each level its digest and its run's others."""
    return f"""
{name}(row, grp, idx, level, found, others) AS (
  SELECT row, grp, idx, 0, found, '' FROM {start}
  UNION ALL
  SELECT w.row, w.grp, w.idx // 8, w.level + 1,
    sha256(string_agg(CASE WHEN t.idx = w.idx THEN w.found ELSE t.h END, '' ORDER BY t.idx)),
    coalesce(string_agg(t.h, '' ORDER BY t.idx) FILTER (t.idx <> w.idx), '')
  FROM {name} w JOIN {tree} t ON t.grp = w.grp AND t.level = w.level AND t.idx // 8 = w.idx // 8 AND t.n > 1
  GROUP BY w.row, w.grp, w.idx, w.level, w.found)"""


#: CRC-32 of a number's decimal digits, in DuckDB.
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295)"""
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    f"""
WITH RECURSIVE d AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS grp, {_leaf_sql("text")} AS h,
    CASE WHEN {CRC} % 3 = 0 THEN {_leaf_sql(LOWERED)} ELSE {_leaf_sql("text")} END AS found FROM documents),
leaf AS (SELECT *, row_number() OVER (ORDER BY grp, doc_id NULLS FIRST, h) AS row,
    row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS idx FROM d),
{_grown_sql("low", "leaf")},
sub AS (SELECT '' AS grp, grp AS name, h, row_number() OVER (ORDER BY grp) - 1 AS idx FROM low WHERE n = 1),
{_grown_sql("high", "sub")},
{_walked_sql("up", "low", "leaf")},
below AS (SELECT row, arg_max(found, level) AS found, string_agg(others, '' ORDER BY level) AS others FROM up GROUP BY row),
crossing AS (SELECT b.row, s.grp, s.idx, b.found, b.others, s.h AS subroot
  FROM below b JOIN leaf l ON l.row = b.row JOIN sub s ON s.name = l.grp),
{_walked_sql("top", "high", "crossing")},
over AS (SELECT row, arg_max(found, level) AS found, string_agg(others, '' ORDER BY level) AS others FROM top GROUP BY row)
SELECT l.doc_id, l.h AS leaf, c.subroot, r.h AS root, sha256(c.others || o.others) AS proof_sha256,
  o.found AS folded_root, o.found = r.h AS verified
FROM leaf l JOIN crossing c ON c.row = l.row JOIN over o ON o.row = l.row JOIN high r ON r.n = 1"""
)
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.when(F.col("text").isNotNull(), lower_ascii(F.col("text")))
    tampered = fold(F.col("doc_id"), 3) == 0
    now = merkle.leaf_digest([*fields, F.when(tampered, lowered).otherwise(F.col("text"))])
    leaf = merkle.leaf_digest([*fields, F.col("text")])
    proved = merkle.proofs(merkle.build(docs, "doc_id", "lang", leaf, found=now), "found")
    return proved.withColumnRenamed("key", "doc_id")
