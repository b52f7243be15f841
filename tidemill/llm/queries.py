"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import (
    bpe_ranks, host_reputation, imatch, merkle_log, minhash, packing, recurrent_lm, secret_scan, stable_ann, token_alignment,
    token_files, toxicity, winnowing)
from tidemill.plans.inputs import table

import corpus_pipeline

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


#: The rules of the page query.
PAGE_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
              ("allow", "org", "/fr/")]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def pipeline(spark, sf_dir):
    """The corpus pipeline over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


@query
def op1_toxicity(spark, sf_dir):
    """Toxicity score of all documents."""
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "toxic")


@query
def op2_secrets(spark, sf_dir):
    """Spans of secrets in all documents."""
    return secret_scan.digest(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


@query
def op3_packing(spark, sf_dir):
    """Pieces of all documents in windows of 4096 ids."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), WORD_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


@query
def op4_recurrent_lm(spark, sf_dir):
    """Log-likelihood of all documents under the recurrent model and under add-one counts."""
    return recurrent_lm.score_documents(table(spark, sf_dir, "documents"))


@query
def op5_minhash(spark, sf_dir):
    """Component of every document under links of 85 in 100 common shingles of three words."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, similarity=0.85)


@query
def op6_stable_ann(spark, sf_dir):
    """The 20 nearest rows of every row whose id is divisible by 20."""
    rows = table(spark, sf_dir, "embeddings")
    return stable_ann.nearest(rows, rows.where(F.col("vec_id") % 20 == 0), 20)


@query
def op7_token_files(spark, sf_dir):
    """Ids of all documents, written as grammar-compressed shards and read back."""
    return token_files.digest_documents(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op8_imatch(spark, sf_dir):
    """Fingerprints of all documents and of their edited texts."""
    return imatch.compare(imatch.fingerprints(table(spark, sf_dir, "documents")))


@query
def op9_bpe(spark, sf_dir):
    """Ids and decoded text of all documents, as digests."""
    return bpe_ranks.digest_documents(table(spark, sf_dir, "documents"), WORD_BPE)


@query
def op10_host_reputation(spark, sf_dir):
    """Verdict for every page: the longest rule, else its host's reputation; a page of low quality is a bad outcome."""
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).cast("long").alias("bad"))
    judged = host_reputation.judge(table(spark, sf_dir, "pages"), outcomes, PAGE_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.col("n").alias("host_outcomes"),
                         F.col("k").alias("host_bad"))


@query
def op11_winnowing(spark, sf_dir):
    """Benchmark windows in all documents."""
    found = winnowing.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), "contaminated")


@query
def op12_merkle_log(spark, sf_dir):
    """Proofs of all documents, and the roots that tampered ones fold to."""
    return merkle_log.prove(merkle_log.manifest(table(spark, sf_dir, "documents")))


@query
def op13_token_alignment(spark, sf_dir):
    """Links between the ids of two vocabularies in all documents, with the counts of the whole corpus."""
    aligned = token_alignment.align_documents(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)
    return aligned.withColumnRenamed("groups", "groups_sha256")


ORACLE_SQL["op10_host_reputation"] = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substring(url, strpos(url, '://') + 3) END AS rest FROM pages),
named AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
seen AS (
  SELECT doc_id AS page_id, count(*) AS n, sum(1 - quality) AS k FROM labels
  WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
counted AS (
  SELECT host, coalesce(sum(n), 0) AS n, coalesce(sum(k), 0) AS k FROM named LEFT JOIN seen USING (page_id) GROUP BY host),
labels_of AS (
  SELECT *, regexp_replace(regexp_replace(host, '^[^@]*@', ''), '[.]?(:[0-9]*)?$', '') AS name FROM counted),
tails AS (
  SELECT host, n, k, name, (regexp_matches(name, '^[0-9.]+$') OR contains(name, '[')) AS numbers,
    list_reverse(string_split(name, '.')) AS l FROM labels_of),
hosts AS (
  SELECT host, n, k,
    CASE WHEN numbers THEN name WHEN list_aggregate(list_reverse(l[1:2]), 'string_agg', '.') IN ({double})
      THEN list_aggregate(list_reverse(l[1:3]), 'string_agg', '.')
      ELSE list_aggregate(list_reverse(l[1:2]), 'string_agg', '.') END AS domain,
    CASE WHEN numbers THEN name WHEN list_aggregate(list_reverse(l[1:2]), 'string_agg', '.') IN ({double})
      THEN list_aggregate(list_reverse(l[1:2]), 'string_agg', '.') ELSE l[1] END AS suffix FROM tails),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL),
suffixes AS (
  SELECT suffix, sum(n) AS n, sum(k) AS k,
    (SELECT CASE WHEN sum(n) > 0 THEN sum(k) / sum(n) ELSE 0.0 END FROM domains) AS m FROM domains GROUP BY suffix),
w1 AS (SELECT 1 / least(greatest(CASE WHEN sum(n * (n - 1) * m * (1 - m)) > 0 THEN
    sum((k - n * m) ** 2 - n * m * (1 - m)) / sum(n * (n - 1) * m * (1 - m)) ELSE 0.0 END, {low}), {high}) - 1 AS w
  FROM suffixes),
d AS (SELECT domain, suffix, domains.n, domains.k, (suffixes.k + w * m) / (suffixes.n + w) AS m
  FROM domains JOIN suffixes USING (suffix), w1),
w2 AS (SELECT 1 / least(greatest(CASE WHEN sum(n * (n - 1) * m * (1 - m)) > 0 THEN
    sum((k - n * m) ** 2 - n * m * (1 - m)) / sum(n * (n - 1) * m * (1 - m)) ELSE 0.0 END, {low}), {high}) - 1 AS w
  FROM d),
h AS (SELECT host, hosts.n, hosts.k, (d.k + w * m) / (d.n + w) AS m FROM hosts JOIN d USING (domain, suffix), w2),
w3 AS (SELECT 1 / least(greatest(CASE WHEN sum(n * (n - 1) * m * (1 - m)) > 0 THEN
    sum((k - n * m) ** 2 - n * m * (1 - m)) / sum(n * (n - 1) * m * (1 - m)) ELSE 0.0 END, {low}), {high}) - 1 AS w
  FROM h),
posterior AS (SELECT host, n, k, n + w AS size, (k + w * m) / (n + w) AS rate FROM h, w3),
bounds AS (SELECT host, n, k, rate - {spread} * sqrt(rate * (1 - rate) / (size + 1)) AS bound FROM posterior),
rules(action, rhost, rpath) AS (VALUES {rules}),
fitting AS (
  SELECT page_id, host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
    arg_max(action, length(rhost || rpath)) AS action
  FROM (SELECT DISTINCT page_id, host, path FROM named)
  JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY ALL)
SELECT page_id, host, path, rule,
  coalesce(action, CASE WHEN round(bound, 9) > {limit} THEN 'block' ELSE 'allow' END) AS verdict,
  CAST(n AS BIGINT) AS host_outcomes, CAST(k AS BIGINT) AS host_bad
FROM named JOIN bounds USING (host) LEFT JOIN fitting USING (page_id, host, path)
""".format(double=", ".join(f"'{s}'" for s in host_reputation.DOUBLE_SUFFIXES), low=1 / (host_reputation.MOST_WEIGHT + 1),
           high=1 / (host_reputation.LEAST_WEIGHT + 1), spread=host_reputation.SPREAD, limit=host_reputation.LIMIT,
           rules=", ".join(str(r) for r in PAGE_RULES))

ORACLE_SQL["op11_winnowing"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
opened AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS t FROM opened),
lengths AS (SELECT DISTINCT n FROM windows),
stretches AS (SELECT r, n, w, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d JOIN lengths ON len(w) >= n),
hits AS (
  SELECT r, n, s, t FROM (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS t FROM stretches)
  SEMI JOIN windows USING (n, t)),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY r),
held AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits JOIN windows USING (n, t) WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN held USING (r)
"""

_FIELDS = " || ".join(f"coalesce(strlen(CAST({{{c}}} AS VARCHAR)) || ':' || CAST({{{c}}} AS VARCHAR), '-')"
                      for c in merkle_log.FIELDS)
ORACLE_SQL["op12_merkle_log"] = """
WITH RECURSIVE summed AS (
  SELECT *, xor(4294967295, list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda ch: [CAST(ord(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, 4294967295)) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, coalesce('=' || source, '') AS name, sha256({leaf}) AS leaf,
    CASE WHEN crc % 2 = 0 THEN sha256({altered}) ELSE sha256({leaf}) END AS given FROM summed),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY name) AS n FROM hashed),
tree AS (
  SELECT name, 0 AS level, i, leaf AS h, n FROM leaves
  UNION ALL
  SELECT name, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM tree WHERE n > 1
  GROUP BY name, level, i // 3, n),
subroots AS (SELECT name, h AS subroot, row_number() OVER (ORDER BY name) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
above AS (
  SELECT 0 AS level, i, subroot AS h, n FROM subroots
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM above WHERE n > 1 GROUP BY level, i // 3, n),
nodes AS (SELECT name, level, i, h, n FROM tree UNION ALL SELECT NULL, level, i, h, n FROM above),
sides AS (
  SELECT name, level, i, n, coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM nodes WINDOW run AS (PARTITION BY name, level, i // 3 ORDER BY i)),
lower_way AS (
  SELECT doc_id, name, leaf, i AS place, 0 AS level, i, given AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT doc_id, name, leaf, place, level + 1, i // 3, sha256(l || h || r), proof || l || r
  FROM lower_way JOIN sides USING (name, level, i) WHERE n > 1),
reached AS (
  SELECT doc_id, name, leaf, place, h, proof, subroots.i, subroot
  FROM (SELECT *, row_number() OVER (PARTITION BY name, place ORDER BY level DESC) AS k FROM lower_way) JOIN subroots USING (name)
  WHERE k = 1),
upper_way AS (
  SELECT doc_id, name, leaf, place, subroot, 0 AS level, i, h, proof FROM reached
  UNION ALL
  SELECT doc_id, upper_way.name, leaf, place, subroot, level + 1, i // 3, sha256(l || h || r), proof || l || r
  FROM upper_way JOIN (SELECT * EXCLUDE (name) FROM sides WHERE name IS NULL) USING (level, i) WHERE n > 1),
ended AS (SELECT *, row_number() OVER (PARTITION BY name, place ORDER BY level DESC) AS k FROM upper_way)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, ended.h AS folded_root, ended.h = root AS verified
FROM ended, (SELECT h AS root FROM above WHERE n = 1) WHERE k = 1
""".format(leaf=_FIELDS.format(**{c: c for c in merkle_log.FIELDS}),
           altered=_FIELDS.format(**{c: c if c != "text" else "replace(text, chr(10), '')" for c in merkle_log.FIELDS}))
