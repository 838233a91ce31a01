"""The queries of this subpackage: opN_<name>, one per operator, with their SQL.

Each applies its operator with production parameters to the whole table and
derives the columns of its contract from the operator's output.
"""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import ann, binary, bpe, classifier, codes, jaccard, licenses, mixing, pii, rules, runs, secrets, simhash
from .common import documents, span_columns

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return register


# 1. Mixing -------------------------------------------------------------------
# Water filling by sorted caps; the line of each source by a window; times of
# the default curriculum (weights 7.5 -> 2.5, 2, 0.5 -> 1.5) by its integrals.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), ''))[:15] AS BIGINT) AS h FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS k FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][k + 1]::DOUBLE AS w, source_size * 3.0::DOUBLE AS cap,
         source_size * 3.0::DOUBLE / [5.0, 2.0, 1.0][k + 1]::DOUBLE AS r FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY r, source IS NULL, source
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY r, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            AS level FROM weighed),
targets AS (
  SELECT source, source_size, k,
         least(cap, w * (SELECT arg_min(level, (r, source IS NULL, source)) FROM levels WHERE r > level)) AS target
  FROM levels),
laid AS (
  SELECT doc_id, size, source_size, target, k,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY h, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT *, greatest(0, least(size, floor(target) - pos)) AS c0,
         greatest(0, least(size, floor(target) - pos - source_size)) AS c1,
         greatest(0, least(size, floor(target) - pos - 2 * source_size)) AS c2 FROM laid),
timed AS (SELECT *, (pos + c0 / 2) / nullif(target, 0) AS x FROM copies)
SELECT doc_id, size, source_size, target, CAST(c0 + c1 + c2 AS BIGINT) AS taken,
       CASE WHEN c0 > 0 THEN round(least(1.0, CASE k
         WHEN 0 THEN 2 * x / (1.5 + sqrt(greatest(0.0, 2.25 - 2 * x)))
         WHEN 1 THEN x
         ELSE 2 * x / (0.5 + sqrt(0.25 + 2 * x)) END), 6) END AS first_position
FROM timed
"""


@query("op1_mix_sources", MIX_SQL)
def op1(spark, sf_dir):
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken",
                        F.round(F.get("copies.position", F.lit(0)), 6).alias("first_position"))


# 7. SimHash near-dedup ---------------------------------------------------------
@query("op7_simhash_dedup")
def op7(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, radius=2)


# 10. Quality classifier ----------------------------------------------------------
@query("op10_quality_classifier")
def op10(spark, sf_dir):
    return classifier.score(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


# 5. BPE --------------------------------------------------------------------------
@query("op5_bpe_round_trip")
def op5(spark, sf_dir):
    docs, tokenizer = documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(docs, tokenizer, bpe.build_lexicon(docs, tokenizer))


# 6. Token files ------------------------------------------------------------------
@query("op6_token_files")
def op6(spark, sf_dir):
    folder = binary.fresh_folder(spark)
    binary.write(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), folder, end_id=0)
    return binary.read(spark, folder)


# 9. Secrets ----------------------------------------------------------------------
@query("op9_secret_scan")
def op9(spark, sf_dir):
    return secrets.scan(documents(spark, sf_dir)).select("doc_id", *span_columns("_spans", secrets.KINDS))


# 2. Licenses ---------------------------------------------------------------------
@query("op2_license_scan")
def op2(spark, sf_dir):
    named = F.transform("matches", lambda m: F.concat_ws(
        ":", m["license"], m["start"].cast("string"), m["end"].cast("string")))
    return licenses.scan(documents(spark, sf_dir)).select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_join(named, ",").alias("spans"),
        F.array_max(F.col("matches.coverage")).alias("best_coverage"))


# 3. Personal data ----------------------------------------------------------------
@query("op3_personal_data")
def op3(spark, sf_dir):
    return pii.scan(documents(spark, sf_dir)).select("doc_id", *span_columns("_spans", pii.KINDS))


# 4. Quality rules ----------------------------------------------------------------
@query("op4_quality_rules")
def op4(spark, sf_dir):
    return rules.judge(documents(spark, sf_dir), read_table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# 8. Nearest neighbours -------------------------------------------------------------
@query("op8_nearest_neighbours")
def op8(spark, sf_dir):
    return ann.search(read_table(spark, sf_dir, "embeddings"), every=50, k=5)


# 11. N-gram Jaccard join -----------------------------------------------------------
# Overlaps by a join on the n-gram, components by spreading ids over links.
JACCARD_SQL = r"""
WITH RECURSIVE worded AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(w[k:k + 4], ' ') AS g FROM (
    SELECT r, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS k FROM worded WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM grams GROUP BY r),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS o FROM grams x JOIN grams y ON x.g = y.g AND x.r <> y.r GROUP BY ALL)
  JOIN sizes s ON s.r = a JOIN sizes t ON t.r = b WHERE 100 * o >= 80 * (s.n + t.n - o)),
reach AS (
  SELECT r AS a, r AS b FROM worded
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT w.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM worded w LEFT JOIN sizes s ON s.r = w.r JOIN reach ON reach.a = w.r JOIN worded o ON o.r = reach.b
GROUP BY w.r, w.doc_id
"""


@query("op11_jaccard_join", JACCARD_SQL)
def op11(spark, sf_dir):
    return jaccard.classes(documents(spark, sf_dir), width=5, percent=80)


# 12. Vector codes ------------------------------------------------------------------
# One row per (vector, part); a round is an assignment by list arithmetic and new
# entries by sums of components; integer division goes toward zero, hence the remainder.
_CODES_ROUND = r"""
near{k} AS MATERIALIZED (
  SELECT i, p, arg_min(e, d * 1000 + e) AS e, min(d) AS d FROM (
    SELECT c.i, c.p, b.e, CAST(list_sum(list_transform(list_zip(c.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS HUGEINT) AS d
    FROM cut c JOIN book{k} b ON b.p = c.p) GROUP BY i, p),"""
_CODES_BOOK = r"""
sums{k} AS (
  SELECT p, e, j, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS x FROM (
    SELECT n.p, n.e, unnest(c.v) AS x, generate_subscripts(c.v, 1) AS j FROM near{k} n JOIN cut c ON c.i = n.i AND c.p = n.p)
  GROUP BY p, e, j),
book{next} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(s.v, b.v) AS v FROM book{k} b
  LEFT JOIN (SELECT p, e, list(CAST(x AS BIGINT) ORDER BY j) AS v FROM sums{k} GROUP BY p, e) s ON s.p = b.p AND s.e = b.e),"""
CODES_SQL = (r"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT i, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS v FROM kept, range(4) t(p)),
starts AS (
  SELECT i, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept WHERE vec_id IS NOT NULL ORDER BY vec_id LIMIT 256),
book0 AS MATERIALIZED (SELECT c.p, s.e, c.v FROM starts s JOIN cut c ON c.i = s.i),"""
             + "".join((_CODES_ROUND + _CODES_BOOK).format(k=k, next=k + 1) for k in range(4)) + _CODES_ROUND.format(k=4)
             + r"""
digest AS (
  SELECT sha256(string_agg(x, ',' ORDER BY p, e, j)) AS h FROM (
    SELECT p, e, CAST(unnest(v) AS VARCHAR) AS x, generate_subscripts(v, 1) AS j FROM book4)),
coded AS (
  SELECT i, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near4 GROUP BY i)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       (SELECT h FROM digest) AS codebooks_sha256
FROM kept k JOIN coded c ON c.i = k.i
""")


@query("op12_vector_codes", CODES_SQL)
def op12(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    books = codes.train(vectors, size=256, parts=4, rounds=4, scale=1024)
    coded = codes.with_label_error(codes.encode(vectors, books, scale=1024))
    return coded.select(
        "vec_id", F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "").alias("code"),
        "error", "label_error", F.lit(codes.books_digest(books)).alias("codebooks_sha256"))


# 13. Periodic runs -----------------------------------------------------------------
def looped(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's change of a tenth of the documents: from a place on, words go round."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


@query("op13_periodic_runs")
def op13(spark, sf_dir):
    found = runs.detect(documents(spark, sf_dir), edit=looped).withColumn("best", runs.longest("runs"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(runs.run_lines("runs"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
