"""Registered queries of the operators, each over its whole table, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm import common, decontaminate, divergence, fingerprints, katz, mixing, near_dup, quality, secrets, suffix_dedup, token_counts, url_filters, vector_codes, warc
from txnlake.session import work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TOKENIZER = "byte_bpe_50k.json"


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so that every distinct text is encoded."""
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, str(public_tokenizers.path(TOKENIZER)), work_path(spark, "token-cache"))


@query
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(common.table(spark, sf_dir, "documents"), percent=85).drop("text_hash")


SQL["op2_near_duplicates"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_have >= 85 * (x.n + y.n - both_have)),
l AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS o FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.o = l.a),
c AS (SELECT doc_id, min(o) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@query
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(common.table(spark, sf_dir, "documents"))


@query
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(common.table(spark, sf_dir, "documents"))


@query
def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(common.table(spark, sf_dir, "pages"))
    number = r"^<urn:x-page:(-?\d+)>$"
    page = F.expr("try_cast(regexp_extract(record_id, '^<urn:x-page:(-?[0-9]+)>$', 1) as bigint)")
    first = F.when(F.col("refers_to").rlike(number), F.regexp_extract("refers_to", number, 1).cast("long"))
    return records.select(page.alias("page_id"), "payload_bytes", "payload_digest", "record_type", first.alias("refers_to"))


SQL["op5_warc_round_trip"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first_id < d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id < d.page_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""

@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


# Fixed values of the rule table: host, path, action.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url")
    named = [F.struct(F.lit(host).alias("host"), F.lit(path).alias("path"), F.lit(action).alias("action")) for host, path, action in URL_RULES]
    rules = spark.range(1).select(F.inline(F.array(*named)))
    return url_filters.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


SQL["op7_url_filters"] = r"""
WITH r(rh, rp, action) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                                  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (SELECT row_number() OVER () AS n, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT n, page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT n, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
m AS (SELECT n, rh || rp AS rule, action, row_number() OVER (PARTITION BY n ORDER BY length(rh) + length(rp) DESC, length(rh) DESC, action DESC, rh || rp DESC) AS k
      FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN (SELECT * FROM m WHERE k = 1) USING (n)
"""


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return quality.judged(docs, quality.train(docs, common.table(spark, sf_dir, "labels")))


@query
def op10_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(common.remainder_of_id() == 1, F.lit(False))
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", (~held).alias("train"))
    model = katz.Model(docs)
    return model.scores().select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.compressed(common.table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


# Points and entries as rows of one component each; an assignment is the least distance, then the least index.
SQL["op11_vector_codes"] = r"""
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, label, embedding, len(embedding) // 16 AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (
  SELECT n, i // w AS p, i % w AS d, floor(256 * embedding[i + 1]::DOUBLE)::BIGINT AS x
  FROM (SELECT n, w, embedding, unnest(range(16 * w)) AS i FROM v)),
s AS (SELECT n, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v ORDER BY vec_id LIMIT 64),
c0 AS (SELECT p, e, d, x AS c FROM x JOIN s USING (n)),
""" + "".join(
    f"""
a{i} AS (SELECT n, p, min(k) // 64 AS dist, min(k) % 64 AS e
  FROM (SELECT n, p, e, sum((x - c) * (x - c)) * 64 + e AS k FROM x JOIN c{i} USING (p, d) GROUP BY n, p, e) GROUP BY n, p),
"""
    + (
        f"""
c{i + 1} AS (SELECT p, e, d, coalesce(CAST(floor(m) AS BIGINT), c) AS c
  FROM c{i} LEFT JOIN (SELECT p, e, d, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS m FROM x JOIN a{i} USING (n, p) GROUP BY p, e, d) USING (p, e, d)),
"""
        if i < 2
        else ""
    )
    for i in range(3)
) + r"""
t AS (SELECT n, string_agg(lpad(printf('%x', e::BIGINT), 2, '0'), '' ORDER BY p) AS code, sum(dist)::BIGINT AS error FROM a2 GROUP BY n),
h AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, d)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM v JOIN t USING (n), h
"""


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(common.table(spark, sf_dir, "documents"))


SQL["op12_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
o AS (SELECT n, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY ALL HAVING count(DISTINCT n) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
f AS (SELECT lang, source, term, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v)::BIGINT AS p FROM f JOIN v USING (lang)),
q AS (SELECT lang, term, 1 + (1000000000 * (sum(n)::BIGINT + 5)) // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * any_value(v))::BIGINT AS q FROM f JOIN v USING (lang) GROUP BY lang, term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
w AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r)
SELECT lang, source, part, item, value, rank FROM w WHERE part = 'pair' OR rank <= 50
"""


@query
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(common.table(spark, sf_dir, "documents"))
