"""The corpus operators as registered queries over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arearisk.llm import (
    bpe, exactdup, language, neardup, packing, quality, secrets, shards, spelling, tokencount, toxicity, warc, whitening)
from workload.base import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return add


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_pair_index_bpe(spark: SparkSession, sf: str) -> DataFrame:
    done = bpe.round_trip(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"))
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op2_external_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    done = shards.shards(shards.external_shuffle(table(spark, sf, "documents")), 8)
    text = F.coalesce("text", F.lit(""))
    return done.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query()
def op3_vector_packing(spark: SparkSession, sf: str) -> DataFrame:
    done = packing.pack_documents(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"))
    return done.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query()
def op4_kneser_ney_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    done = toxicity.score_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return done.select("doc_id", "held_out", "score", "predicted", "toxic_logp", "ordinary_logp")


def _secrets_sql() -> str:
    """Matches of each rule cut out with a mark; running lengths of the parts are their places."""
    parts, spans = ["d AS (SELECT doc_id, replace(coalesce(text, ''), chr(57344), chr(57345)) AS t FROM documents)"], []
    for place, rule in enumerate(secrets.RULES):
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        parts.append(f"""m{place} AS (SELECT doc_id, string_split(regexp_replace(t, {pattern}, chr(57344) || '\\0' || chr(57344), 'g'), chr(57344)) AS a
  FROM d WHERE regexp_matches(t, {pattern}))""")
        parts.append(f"e{place} AS (SELECT doc_id, unnest(a) AS x, generate_subscripts(a, 1) AS i FROM m{place})")
        parts.append(f"s{place} AS (SELECT doc_id, i, x, sum(length(x)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM e{place})")
        spans.append(f"SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, stop - length(x) AS start, stop FROM s{place} "
                     f"WHERE i % 2 = 0 AND length(regexp_extract(x, {pattern}, {rule.group})) >= {rule.least}")
    parts.append("spans AS (" + " UNION ALL ".join(spans) + ")")
    joined = "coalesce(string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, place){0}, '')"
    return f"""WITH {", ".join(parts)}
SELECT d.doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access, count(*) FILTER (place = 2) AS n_hex,
       sha256({joined.format(" FILTER (place < 3)")}) AS base_sha256, {joined.format("")} AS spans
FROM d LEFT JOIN spans s ON d.doc_id = s.doc_id GROUP BY d.doc_id"""


@query(_secrets_sql())
def op5_trigram_secrets(spark: SparkSession, sf: str) -> DataFrame:
    done = secrets.scan(table(spark, sf, "documents"))
    counts = [F.size(F.filter("spans", secrets.is_rule(p))).cast("long").alias(f"n_{secrets.RULES[p].kind}") for p in range(3)]
    return done.select("doc_id", *counts, F.sha2(secrets.named_spans(F.col("spans"), first=3), 256).alias("base_sha256"),
                       secrets.named_spans(F.col("spans")).alias("spans"))


@query()
def op6_weighted_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf, "documents")).select("doc_id", "class_id", "class_size", "links")


@query()
def op7_isolation_forest(spark: SparkSession, sf: str) -> DataFrame:
    done = quality.judge_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return done.select("doc_id", *quality.COUNTS, "base_failed", "kept", "anomaly")


@query()
def op8_heap_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf, "documents"), vocabulary("piece_bpe_32k.model"))


def _base32_sql(x: str, i: int) -> str:
    """Character i of the base32 form of a hexadecimal digest: four of them for five hexadecimal digits."""
    five = f"CAST('0x' || substr({x}, {i // 4 * 5 + 1}, 5) AS BIGINT)"
    return f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(({five} >> {15 - 5 * (i % 4)}) & 31 AS INTEGER) + 1, 1)"


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS n, sha1(html) AS x, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, n AS payload_bytes, """ + " || ".join(_base32_sql("x", i) for i in range(32)) + """ AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM h""")
def op9_zip_warc(spark: SparkSession, sf: str) -> DataFrame:
    done = warc.read_packages(warc.write_packages(table(spark, sf, "pages")), payloads=False)
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)""")
def op10_tree_merge(spark: SparkSession, sf: str) -> DataFrame:
    done = exactdup.exact_groups(table(spark, sf, "documents"))
    return done.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query()
def op11_language_families(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(table(spark, sf, "documents"))


@query()
def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf, "documents"))


@query()
def op13_exact_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))
