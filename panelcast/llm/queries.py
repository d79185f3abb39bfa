"""The registered queries of the pipeline operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import bitpack, cotrain, ctw, decontam, fim, mil, neardup, packing, substring, topk, turns, url_filter, warc
from panelcast.llm.common import table
from panelcast.llm.oracles import OP4_SQL, OP8_SQL, OP9_SQL, OP12_SQL

def vocabulary(name: str) -> str:
    """Where the installed package of public tokenizers has a vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Fixed by the contract of op1: host, path, verdict.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_filter.judge(table(spark, sf_dir, "pages"), listed)
    return judged.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


OP1_SQL = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
parts AS (
  SELECT page_id, url,
         CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*', 0)) + 1), '^[^?#]*', 0) AS path
  FROM parts),
fits AS (
  SELECT s.page_id, s.host, s.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY s.page_id, s.host, s.path
                            ORDER BY length(r.host || r.path) DESC NULLS LAST, length(r.host) DESC) AS k
  FROM split s LEFT JOIN rules r
    ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path))
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM fits WHERE k = 1
"""


def op2_ctw_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    return ctw.score(table(spark, sf_dir, "documents"), remainder == 2)


def op3_cotraining_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = cotrain.fit(docs, table(spark, sf_dir, "labels"))
    return cotrain.classify(docs, model).select(F.col("row.doc_id").alias("doc_id"), "p_text", "p_meta", "score", "kept")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"), width=20)
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed",
                        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256)


OP5_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, len(v) AS n, unnest(v) AS x, unnest(range(len(v))) AS i FROM usable),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.vec_id % 50 = 0 AND c.i = q.i AND c.vec_id <> q.vec_id AND c.n = q.n
  GROUP BY ALL),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op6_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0, length=1024)


def op7_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_pages(table(spark, sf_dir, "pages"))
    return warc.read_pages(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = """
WITH payloads AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes
  FROM pages),
firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS first
  FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM firsts
"""


def op8_chosen_path_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.find_groups(table(spark, sf_dir, "documents"), shingle=4, percent=80)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=13, share=20)
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op10_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.read_ids(bitpack.write_ids(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2))


def op11_rank_index_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents"), seed=42, rate=50, spm_rate=80)
    back = fim.restored(F.col("output"), F.col("form"))
    return made.select(F.col("row.doc_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


OP11_SQL = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || CAST(doc_id AS VARCHAR)) AS x,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t
  FROM documents),
d AS (
  SELECT doc_id, text, t, len(t) AS n, CAST('0x' || substr(x, 1, 8) AS BIGINT) % (len(t) + 1) AS c1,
         CAST('0x' || substr(x, 9, 8) AS BIGINT) % (len(t) + 1) AS c2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || substr(x, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || substr(x, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
cut AS (
  SELECT *, array_to_string(list_slice(t, 1, least(c1, c2)), '') AS prefix,
         array_to_string(list_slice(t, least(c1, c2) + 1, greatest(c1, c2)), '') AS middle,
         array_to_string(list_slice(t, greatest(c1, c2) + 1, n), '') AS suffix
  FROM d)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage to ``conversations``, as prepared rows."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    hurt = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
                       F.when(kind != 0, text).alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))
    return turns.prepared(hurt, copies=F.col("copies"))


def op12_hirschberg_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = turns.repair(damaged(table(spark, sf_dir, "conversations")))
    texts = turns.digests(found.pieces).withColumnRenamed("conv", "__conv")
    report = found.report.join(texts, F.col("conv").eqNullSafe(F.col("__conv")))
    return report.select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op13_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = mil.fit(docs, labels, trained=~held_out)
    scored = mil.score(docs.select("doc_id", "text"), model)
    remainder = F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 4
    return scored.select(F.col("row.doc_id").alias("doc_id"), F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_ctw_scoring": op2_ctw_scoring,
    "op3_cotraining_quality": op3_cotraining_quality,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_curve_packing": op6_curve_packing,
    "op7_warc_dictionary": op7_warc_dictionary,
    "op8_chosen_path_near_dedup": op8_chosen_path_near_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_bit_packing": op10_bit_packing,
    "op11_rank_index_fim": op11_rank_index_fim,
    "op12_hirschberg_repair": op12_hirschberg_repair,
    "op13_noisy_or_toxicity": op13_noisy_or_toxicity,
}

ORACLES = {
    "op1_url_filter": OP1_SQL,
    "op4_substring_dedup": OP4_SQL,
    "op5_exact_top_k": OP5_SQL,
    "op7_warc_dictionary": OP7_SQL,
    "op8_chosen_path_near_dedup": OP8_SQL,
    "op9_decontamination": OP9_SQL,
    "op11_rank_index_fim": OP11_SQL,
    "op12_hirschberg_repair": OP12_SQL,
}
