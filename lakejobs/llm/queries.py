"""Queries of the operators over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs.llm import collocations, decontamination, mixing, pii, quality, secrets, sharding, simhash, spelling, token_counts, topk, toxicity, warc
from lakejobs.llm.common import table
from lakejobs.llm.spans import labelled
from lakejobs.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def keep(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return build(spark, sf_dir)

        QUERIES[key] = run
        if sql:
            ORACLE[key] = sql
        return build

    return keep


@register("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = 40
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = spark.read.parquet(sharding.write_shards(docs, shards=shards))
    return placed.select(
        "doc_id", "size", F.crc32(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot", sharding.shard_of(F.col("doc_id"), shards + 1).alias("grown_shard"))


OP2_SQL = r"""
WITH weighed AS (
  SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END) AS weight FROM labels GROUP BY doc_id),
rows AS (
  SELECT d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         -ln((('0x' || substr(md5(concat(coalesce(d.doc_id::VARCHAR, ''), ':0')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
           / coalesce(w.weight, 1.0)::DOUBLE AS sample_key
  FROM documents d LEFT JOIN weighed w ON w.doc_id = d.doc_id),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
ranked AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight
  FROM sizes),
leveled AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM sizes)
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
filled AS (
  SELECT *, first_value(CASE WHEN cap / weight >= level THEN level END IGNORE NULLS)
              OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS shared
  FROM leveled),
budgets AS (
  SELECT source, source_size, CASE WHEN shared IS NULL THEN cap ELSE least(cap, weight * shared) END AS target FROM filled),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::INT ELSE 0 END AS epochs,
         target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS rest
  FROM budgets),
summed AS (
  SELECT r.doc_id, r.size, e.source_size, e.target, e.epochs, e.rest,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY r.sample_key ROWS UNBOUNDED PRECEDING) - e.rest AS over
  FROM rows r JOIN epochs e ON e.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN rest > 0 AND (over <= 0 OR (over < size AND over * 2 <= size)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""


@register("op2_mixing", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, 2.0).when(
        F.col("quality") == 0, 0.5).otherwise(1.0).alias("weight"))
    mixed = mixing.mix(table(spark, sf_dir, "documents"), quality)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@register("op3_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Base32 of a SHA-1: five hexadecimal digits are four characters.
_DIGITS = ", ".join(f"('0x' || substr(sha1(coalesce(html, '')), {1 + 5 * k}, 5))::INT AS n{k}" for k in range(8))
_LETTERS = " || ".join(f"substr('{warc.BASE32}', 1 + ((n{k} >> {shift}) & 31), 1)" for k in range(8) for shift in (15, 10, 5, 0))
OP4_SQL = f"""
WITH digits AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, {_DIGITS} FROM pages),
named AS (SELECT page_id, payload_bytes, {_LETTERS} AS payload_digest FROM digits),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS low FROM named)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> low THEN low END AS refers_to
FROM firsts
"""


@register("op4_warc", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive(table(spark, sf_dir, "pages"))
    return index.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast("long").alias("refers_to"))


OP5_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256::DOUBLE * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@register("op5_topk", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@register("op7_secrets")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = [(rule.kind, F.col(f"{rule.kind}_spans")) for rule in secrets.BASE_RULES]
    every = [(rule.kind, F.col(f"{rule.kind}_spans")) for rule in secrets.RULES]
    return found.select(
        "doc_id", *[F.size(spans).cast("long").alias(f"n_{kind}") for kind, spans in base],
        F.sha2(labelled(base, by_start=True), 256).alias("base_sha256"), labelled(every, by_start=True).alias("spans"))


@register("op10_pii")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.extract(table(spark, sf_dir, "documents"))
    base = [(kind, F.col(f"{kind}_spans")) for kind in pii.KINDS]
    context = [(f"context_{kind}", pii.of_kind(F.col("context_spans"), kind)) for kind in pii.KINDS]
    return found.select(
        "doc_id", *[F.size(spans).cast("long").alias(f"n_{kind}") for kind, spans in base],
        F.sha2(labelled(base, by_start=False), 256).alias("base_sha256"), labelled(base + context, by_start=False).alias("spans"))


@register("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (~toxicity.learns(F.col("doc_id"))).alias("held_out"), "score", "predicted")


@register("op9_simhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM words, (SELECT unnest([1, 2, 3, 4]) AS size) s WHERE len(w) >= size),
counted AS (SELECT lang, size, phrase, count(*) AS c FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(c)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, size, phrase, c AS a, string_split(phrase, ' ') AS w FROM counted WHERE size > 1 AND c >= 30),
cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS first_part, array_to_string(w[k + 1:], ' ') AS rest
  FROM cand, (SELECT unnest([1, 2, 3]) AS k) s WHERE k < size),
scored AS (
  SELECT t.lang, t.size, t.phrase, t.a, t.k, x.c AS l, y.c AS r, (2000000::HUGEINT * t.a) // (x.c::HUGEINT + y.c) AS score
  FROM cuts t JOIN counted x ON x.lang = t.lang AND x.phrase = t.first_part JOIN counted y ON y.lang = t.lang AND y.phrase = t.rest),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (
  SELECT lang, a, unnest(list_transform(range(1, size - part + 2), lambda i: array_to_string(w[i:i + part - 1], ' '))) AS phrase
  FROM cand, (SELECT unnest([2, 3]) AS part) s WHERE part < size),
longer AS (SELECT lang, phrase, max(a) AS a FROM parts GROUP BY ALL),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
  FROM weakest s LEFT JOIN longer o ON o.lang = s.lang AND o.phrase = s.phrase
  WHERE o.a IS NULL OR 100::HUGEINT * o.a < 80::HUGEINT * s.a)
SELECT r.lang, r.rank::INT AS rank, r.phrase, r.a, r.l, r.r, t.n, r.score::BIGINT AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""


@register("op11_collocations", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@register("op12_quality")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (~toxicity.learns(F.col("doc_id"))).alias("held_out"), "score", "predicted")


@register("op13_spelling")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))
