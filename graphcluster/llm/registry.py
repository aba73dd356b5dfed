"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphcluster.llm import (
    bpe_tree, divergence, html_model, language, mixing, ngram_join, quality, suffix_dedup, token_count,
    token_store, vector_lsh, warc, whitening)
from graphcluster.llm.common import read
from graphcluster.session import scratch_dir

QueryFn = Callable[[SparkSession, str], DataFrame]

END_ID = 2
COUNT_LIMIT = 512


def op1_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe_tree.round_trip(docs, path, public_tokenizers.PATTERN)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = token_count.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return token_count.over_limit(counted, COUNT_LIMIT).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-store")
    token_store.write_store(read(spark, sf_dir, "documents"), folder,
                            public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return token_store.read_store(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents")).select(
        "doc_id", *quality.MEASURES, "base_failed", "kept")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents"))


def held_out(key: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5 == 0


def op6_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = language.learn(docs.where(~F.col("held_out")))
    return language.identify(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score")


def op7_html_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_model.extract(pages, html_model.learn(pages)).select("page_id", "url", "text", "n_chars")


def op8_vector_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_lsh.near_duplicates(read(spark, sf_dir, "embeddings"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.with_size(read(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")
    mixed = mixing.sampled(docs, "source", "doc_id", mixing.WEIGHTS, mixing.MAX_COPIES, mixing.SEED,
                           int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_pages(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.read_warc(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents").select("text", "lang", "source"))


def queries() -> dict[str, QueryFn]:
    fns = [op1_bpe_tree, op2_token_counts, op3_token_store, op4_host_rules,
           op5_ngram_join, op6_language_filters, op7_html_model, op8_vector_lsh,
           op9_suffix_dedup, op10_mix_sources, op11_whitening, op12_arc_to_warc, op13_divergence]
    return {f.__name__: f for f in fns} | {"pipeline": corpus_pipeline.run}


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: SQL for the base32 letters of the hexadecimal digits ``h`` of a SHA-1.
BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {1 + 5 * (i // 4)}, 5))::INT >> {15 - 5 * (i % 4)}) & 31) + 1, 1)"
    for i in range(32))


def oracle_sql() -> dict[str, str]:
    u = mixing.offset()
    return {
        "op4_host_rules": rf"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
g AS (SELECT r, i, [words[i], words[i + 1], words[i + 2]] AS win
      FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (
          SELECT r, unnest([i, i + 1, i + 2]) AS p FROM (
            SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM g) WHERE c > 1) GROUP BY r),
m AS (SELECT w.r, doc_id, source, len(words)::BIGINT AS n_words,
        length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN dup USING (r) LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2,
        2 * n_symbols > n_words AS f3, n_words >= 50 AND 20 * n_dup_lines > n_words AS f4 FROM m),
h AS (SELECT source, unnest([1, 2, 3, 4]) AS rule, count(*) AS n,
        unnest([count(*) FILTER (f1), count(*) FILTER (f2), count(*) FILTER (f3), count(*) FILTER (f4)]) AS k
      FROM f GROUP BY source),
p AS (SELECT rule, avg(k / n) AS mu, var_pop(k / n) AS v FROM h GROUP BY rule),
q AS (SELECT rule, mu, CASE WHEN v = 0 THEN 1e6 ELSE least(1e6, greatest(2.0, mu * (1 - mu) / v - 1)) END AS st FROM p),
bad AS (SELECT source, bool_or((k + mu * st) / (n + st) > 0.5) AS failed FROM h JOIN q USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  f1 OR f2 AS base_failed, NOT (f1 OR f2) AND NOT bad.failed AS kept
FROM f JOIN bad ON f.source IS NOT DISTINCT FROM bad.source""",
        "op8_vector_lsh": """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
       AND len(e) = (SELECT count(*) FROM unnest(e) AS t(x) WHERE isfinite(x))
       AND EXISTS (SELECT 1 FROM unnest(e) AS t(x) WHERE x <> 0)),
pairs AS (SELECT a.r AS a, b.r AS b FROM ok AS a JOIN ok AS b
          ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(r, o) AS (SELECT r, r FROM v UNION SELECT reach.r, pairs.b FROM reach JOIN pairs ON reach.o = pairs.a),
comp AS (SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON reach.o = v.r GROUP BY reach.r),
n AS (SELECT a AS r, count(*) AS n_links FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN comp USING (r) LEFT JOIN n USING (r)""",
        "op10_mix_sources": rf"""
WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, 3 * source_size AS cap FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST) AS k FROM w),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE
             / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS level FROM o
      WINDOW b AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e AS (SELECT min(k) AS k FROM l WHERE cap::DOUBLE / w > level),
t AS (SELECT l.source, l.source_size,
        CASE WHEN l.k >= e.k THEN (SELECT level FROM l AS x, e AS y WHERE x.k = y.k) * w ELSE cap::DOUBLE END AS target
      FROM l, e),
r AS (SELECT d.*, source_size, target, row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id)::DOUBLE AS n,
        CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS step
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, least(3, floor(n * step + {u!r}::DOUBLE) - floor((n - 1) * step + {u!r}::DOUBLE))::BIGINT AS copies FROM r)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c""",
        "op12_arc_to_warc": f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, row_number() OVER w AS k, first_value(page_id) OVER w AS first FROM p
      WINDOW w AS (PARTITION BY h, payload_bytes ORDER BY page_id NULLS LAST))
SELECT page_id, payload_bytes, {BASE32} AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN first END AS refers_to FROM r""",
        "op13_divergence": rf"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
             regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS terms FROM documents),
w AS (SELECT lang, source, r, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.MIN_DOCS}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
tl AS (SELECT lang, sum(total)::HUGEINT AS total FROM t GROUP BY lang),
p AS (SELECT t.lang, t.source, kept.term, coalesce(c.n, 0) AS n,
        1 + ({divergence.SCALE}::HUGEINT * (coalesce(c.n, 0) + {divergence.ALPHA})) // (t.total + {divergence.ALPHA} * v.v) AS p
      FROM t JOIN kept USING (lang) JOIN v USING (lang)
      LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = kept.term),
q AS (SELECT s.lang, s.term, 1 + ({divergence.SCALE}::HUGEINT * (s.n + {divergence.ALPHA})) // (tl.total + {divergence.ALPHA} * v.v) AS q
      FROM (SELECT lang, term, sum(n) AS n FROM p GROUP BY lang, term) AS s JOIN tl USING (lang) JOIN v USING (lang)),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p AS a JOIN p AS b
      ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
      FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
      UNION ALL SELECT p.lang, p.source, 'term', p.term, (p.p - q.q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p.p > q.q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM f)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {divergence.TOP}""",
    }
