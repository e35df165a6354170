"""The registered queries of the subpackage: ``(spark, sf_dir) -> DataFrame`` each, over whole tables,
and their DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm import (archives, conversation_trie, decontaminate, hard_negatives, jaccard_join, mixing, pieces,
                          pseudo_lm, quality, secrets_crf, sharding, url_rules, vector_search)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_jaccard_join(spark, sf_dir):
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op1_decontaminate(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents").select("doc_id", "text"),
                               table(spark, sf_dir, "benchmark"))


@query
def op5_quality_classifier(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents").select("doc_id", "text"),
                            table(spark, sf_dir, "labels").select("doc_id", "quality"))


@query
def op6_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")) \
        .select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op10_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


@query
def op2_url_rules(spark, sf_dir):
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), url_rules.rule_table(spark))


SQL["op2_url_rules"] = r"""
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END r FROM pages),
q AS (SELECT page_id, coalesce(translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') host,
             coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') path FROM p),
rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                                ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
m AS (SELECT q.page_id, max_by(struct_pack(rule := h || p, verdict := verdict), length(h || p)) b
      FROM q JOIN rules ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p) GROUP BY 1)
SELECT q.page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict FROM q LEFT JOIN m USING (page_id)
"""


@query
def op3_vector_search(spark, sf_dir):
    return vector_search.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def op8_legacy_archives(spark, sf_dir):
    return archives.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


SQL["op8_legacy_archives"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
h AS (SELECT payload_digest, max(page_id) AS head FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN head <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN head <> page_id THEN head END AS refers_to
FROM p LEFT JOIN h USING (payload_digest)
"""


@query
def op7_pseudo_likelihood(spark, sf_dir):
    return pseudo_lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op9_secret_scan(spark, sf_dir):
    return secrets_crf.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op12_sentencepiece(spark, sf_dir):
    import public_tokenizers
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = pieces.encoded(docs, model).select("doc_id", "ids")
    return pieces.decoded(ids, model).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op11_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)").alias("label"), "embedding")
    return hard_negatives.mine(vectors, "vec_id % 100 = 0")


SQL["op11_hard_negatives"] = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
             CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
 AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""


@query
def op13_conversation_trie(spark, sf_dir):
    return conversation_trie.trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


SQL["op13_conversation_trie"] = """
WITH t AS (SELECT conv_id AS c, {'r': coalesce(role, ''), 'x': coalesce(text, '')} AS turn,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
v AS (SELECT c, list(turn ORDER BY pos) AS own FROM t GROUP BY c),
h AS (SELECT c, own, c - c % 5 AS base, xor(list_reduce(
        list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))),
        lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
          lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 9 AS h FROM v),
made AS (SELECT h.c, list_concat(list_slice(coalesce(v.own, []), 1, h.h), list_slice(h.own, h.h + 1, len(h.own))) AS path
         FROM h LEFT JOIN v ON v.c = h.base),
m AS (SELECT c, d, len(path) AS size, list_slice(path, 1, d) AS pre FROM made, range(len(path) + 1) AS r(d)),
k AS (SELECT *, min(c) OVER (PARTITION BY d, pre) AS top FROM m),
n AS (SELECT top, d, count(*) AS n_convs, any_value(CASE WHEN d > 0 THEN strlen(pre[d].x) ELSE 0 END) AS bytes,
             sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE size = d), '')) AS ends_sha256
      FROM k GROUP BY top, d),
p AS (SELECT n.*, k.top AS parent FROM n LEFT JOIN k ON k.c = n.top AND k.d = n.d - 1),
f AS (SELECT p.*, (SELECT count(*) FROM p q WHERE q.parent = p.top AND q.d = p.d + 1) AS n_children FROM p),
s AS (SELECT a.top, a.d, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((f.n_convs - 1) * f.bytes) AS saved
      FROM f JOIN k a ON a.c = f.top AND a.d <= f.d GROUP BY a.top, a.d)
SELECT f.top AS conv_id, CAST(f.d AS BIGINT) AS depth, f.parent AS parent_conv_id, f.n_convs, f.n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN s ON s.top = f.top AND s.d = f.d
"""
