"""The registered queries of the training-data operators, and DuckDB SQL for those it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.llm import bpe, ivfpq, ngram_join, packing, quality_mil, quality_rules, substring_dedup, toxicity, url_filter, warc
from strataforge.llm.shared import work_folder


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages as WARC files in the shared folder, reads them back."""
    folder = work_folder(spark, "warc")
    warc.write_warc(_read(spark, sf_dir, "pages"), folder, least_revisit=0)
    return warc.read_warc(spark, folder).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes all documents."""
    return bpe.round_trip_digests(_read(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judges the URLs of all pages, with trees trained on those that the rules decide."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.fit(pages)
    return url_filter.judge(pages, model).select("page_id", "host", "path", "rule", "verdict")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdicts of all documents."""
    judged = quality_rules.judged(_read(spark, sf_dir, "documents"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *(F.col(f"{quality_rules.HELD}.{c}").alias(c) for c in names))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated windows of 35 words in all documents."""
    return substring_dedup.repeated_spans(_read(spark, sf_dir, "documents"), 35).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of 1024 ids."""
    return packing.pack(_read(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), 1024, 0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores all documents by a lexicon learned from the training labels."""
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity classes of all documents."""
    return ngram_join.similarity_classes(_read(spark, sf_dir, "documents"), 75, 5)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores all documents by multiple-instance learning from the training labels."""
    docs = _read(spark, sf_dir, "documents")
    model = quality_mil.fit(docs, _read(spark, sf_dir, "labels"))
    return quality_mil.score(docs, model, 0.3).select("doc_id", "held_out", "score", "predicted")


def op10_ivfpq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest neighbours of every vector whose id is divisible by 20, among all vectors."""
    return ivfpq.neighbours(_read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


QUERIES = {f.__name__: f for f in (op1_warc, op2_bpe, op3_url_filter, op4_quality_rules, op5_substring_dedup, op6_packing, op7_toxicity, op8_ngram_jaccard, op9_quality, op10_ivfpq)}

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

SQL = {
    "op1_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS hex FROM p),
g AS (SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first_id FROM h)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM g""",
    "op4_quality_rules": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p:p + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) >= 3)),
rep AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM rep) GROUP BY doc_id),
line AS (SELECT doc_id, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, len(list_filter(l, lambda x: regexp_matches(x, '^[\\x20\\x09]*[-*•|]'))) AS n_bullets
  FROM (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d)),
m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, n_lines, n_bullets, length(regexp_replace(t, '[^!]', '', 'g')) AS n_bang,
  len(list_filter(w, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in sorted(set(quality_rules.STOP_WORDS)))}))) AS n_stop
  FROM d JOIN line USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 1.5 * n_words AND 25 * n_words AND n_symbols <= 0.25 * n_words AND n_bang <= 0.5 * n_words
  AND n_stop >= 0.02 * n_words AND n_dup_lines <= 0.5 * n_lines AND n_bullets <= 0.9 * n_lines AS kept
FROM b""",
    "op5_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p:p + 34], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
rep AS (SELECT doc_id, list(p ORDER BY p) AS ps FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY s) AS n FROM win) WHERE n > 1 GROUP BY doc_id),
gone AS (SELECT doc_id, list(DISTINCT q) AS g FROM (SELECT doc_id, unnest(range(p, p + 35)) AS q FROM (SELECT doc_id, unnest(ps) AS p FROM rep)) GROUP BY doc_id),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
lost AS (SELECT doc_id, unnest(g) AS i FROM gone),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN lost USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op8_ngram_jaccard": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, unnest([array_to_string(w[p:p + 4], ' ') FOR p IN range(1, len(w) - 3)]) AS s FROM d WHERE len(w) >= 5
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS k FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.k + y.k - c)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
SELECT d.doc_id, coalesce(k, 0)::BIGINT AS n_shingles, low AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) USING (doc_id)""",
}
