"""The registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontamination import decontaminate
from .embedding_whitening import whiten
from .html_extraction import extract_text
from .mixing import mix_sources
from .near_duplicates import near_duplicates
from .personal_data import find_personal_data
from .quality_rules import quality_rules
from .secret_scan import scan_secrets
from .spelling_variants import count_words, spelling_variants
from .suffix_dedup import remove_repeats
from .token_output import token_digests
from .url_filters import dated_captures, dated_list, evaluate
from .warc import archive

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public vocabulary file; it stays where it is."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@query
def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(spark, table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("text_key")


ORACLES["op3_quality_rules"] = r"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM texts),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, list_slice(w, i, i + 4)) AS c FROM words, range(1, len(w) - 3) AS r(i)),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, range(0, 5) AS r(k) WHERE c > 1 GROUP BY doc_id),
counts AS (
  SELECT doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM words LEFT JOIN repeated USING (doc_id)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS soft
  FROM counts),
hosts AS (SELECT source, count(*) AS docs, count(*) FILTER (base_failed OR soft) AS failed FROM judged GROUP BY source),
moments AS (
  SELECT avg(failed / docs) AS m, coalesce(var_samp(failed / docs), 0) AS v, avg(failed / docs * (1 - failed / docs) / docs) AS c FROM hosts),
prior AS (SELECT m, greatest(m * (1 - m) / greatest(v - c, 1e-6) - 1, 10) AS s FROM moments),
bad AS (SELECT source FROM hosts, prior WHERE (failed + m * s) / (docs + s) > 0.5)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (soft AND EXISTS (SELECT 1 FROM bad b WHERE b.source IS NOT DISTINCT FROM j.source)) AS kept
FROM judged j
"""


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return archive(spark, table(spark, sf_dir, "pages")).select(*columns)


ORACLES["op4_warc"] = """
WITH payloads AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
bits AS (SELECT page_id, n, h, [('0x' || substr(h, 5 * j + 1, 5))::INTEGER FOR j IN range(0, 8)] AS v FROM payloads),
digits AS (
  SELECT page_id, n, h, array_to_string(
    [substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v[k // 4 + 1] >> (15 - 5 * (k % 4))) & 31)::INTEGER + 1, 1) FOR k IN range(0, 32)], '') AS d
  FROM bits),
first AS (SELECT h, max(page_id) AS f FROM payloads GROUP BY h)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest, CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> f THEN f END AS refers_to
FROM digits JOIN first USING (h)
"""


@query
def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = evaluate(dated_captures(pages), dated_list(pages))
    return judged.withColumns({c: judged[c].cast("string") for c in ("fetched_on", "listed_on")})


ORACLES["op5_url_filters"] = r"""
WITH hosts AS (
  SELECT page_id, url, nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.'), '') AS host,
    host || rtrim(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/+', '/', 'g'), '/') AS address,
    DATE '2024-01-01' + (('0x' || substr(md5(coalesce(url, '')), 1, 4))::INTEGER % 500) AS fetched_on
  FROM pages),
split AS (SELECT *, string_split(host, '.') AS labels, string_split(address, '/') AS steps FROM hosts WHERE host IS NOT NULL),
keys AS (
  SELECT page_id, url, fetched_on, 'domain' AS level, 1 AS pos, d AS depth, array_to_string(labels[len(labels) - d + 1 :], '.') AS key
  FROM split, range(2, len(labels) + 1) AS t(d)
  UNION ALL SELECT page_id, url, fetched_on, 'host', 2, 0, host FROM split
  UNION ALL SELECT page_id, url, fetched_on, 'path', 3, d, array_to_string(steps[1 : d + 1], '/') FROM split, range(1, len(steps)) AS t(d)),
entries AS (
  SELECT DISTINCT level, key, DATE '2024-01-01' + (('0x' || substr(md5(level || ':' || key), a.digit, 4))::INTEGER % 500) AS listed_on, a.action
  FROM keys, (VALUES ('block', 1), ('allow', 5), ('block', 9)) AS a(action, digit) WHERE key IS NOT NULL),
found AS (
  SELECT k.page_id, k.url, k.fetched_on, k.level, k.key, k.pos, e.listed_on, e.action,
    row_number() OVER (PARTITION BY k.page_id ORDER BY k.pos DESC, k.depth DESC, e.listed_on DESC, e.action DESC) AS n
  FROM keys k JOIN entries e ON e.level = k.level AND e.key = k.key AND e.listed_on <= k.fetched_on)
SELECT h.page_id, h.url, h.fetched_on::VARCHAR AS fetched_on, f.level AS matched_level, f.key AS matched_key, f.listed_on::VARCHAR AS listed_on,
  CASE f.action WHEN 'block' THEN 'blocked' WHEN 'allow' THEN 'allowed' ELSE 'unlisted' END AS verdict, coalesce(f.action <> 'block', true) AS kept
FROM hosts h LEFT JOIN found f ON f.page_id = h.page_id AND f.n = 1
"""


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), length=200)


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


@query
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


ORACLES["op8_near_duplicates"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS shingle
  FROM words, range(1, greatest(len(w), 2)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
near AS (
  SELECT x, y FROM links JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
steps AS (SELECT x, y FROM near UNION ALL SELECT y, x FROM near),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, s.y FROM reach r JOIN steps s ON r.y = s.x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(y) AS component_id, min(y) = d.doc_id AS kept
FROM documents d JOIN reach r ON r.x = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id
GROUP BY d.doc_id, n
"""


@query
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "times")


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), lines=True)
    return found.select("doc_id", "contaminated", "items", "n_windows", "reparameterised")


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(count_words(table(spark, sf_dir, "documents"), noise=199))
