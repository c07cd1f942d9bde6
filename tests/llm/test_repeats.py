"""Repeated rows, odd weights and long gaps in sharding, mixing, top-k, secrets and personal data."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakejobs.llm import mixing, pii, secrets, sharding, token_counts, topk
from lakejobs.llm import queries as llm
from tests.llm.test_operators import ROWS, SCHEMA, prose


def slots(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns, "shard", "slot").collect())


def test_equal_rows_are_spread_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 50)
    docs = spark.range(2000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("x" * 84).alias("text")).unionAll(
        spark.range(300).select("id", F.concat(F.lit("t"), F.col("id").cast("string"))))
    split = sharding.pieces(docs, 50)
    assert split.agg(F.max("__copies"), F.sum("__copies")).first() == (50, 2300)
    rows = sharding.shard(docs, 3, bucket_bytes=4000)
    found = slots(rows, "doc_id", "text")
    assert sum(found.values()) == 2300 and Counter(k[:2] for k in found.elements())[7, "x" * 84] == 2000
    for shard in range(3):
        taken = sorted(s for (_, _, x, s) in found.elements() if x == shard)
        assert taken == list(range(len(taken)))
    # Copies lie scattered among the other rows of their shard, piece by piece.
    assert slots(sharding.shard(docs.repartition(7), 3, bucket_bytes=4000), "doc_id", "text") == found


def test_rows_that_differ_elsewhere_keep_their_slots(spark):
    docs = spark.range(2000).select(F.lit(1).alias("doc_id"), F.lit("same").alias("text"), F.col("id").alias("other"))
    first = slots(sharding.shard(docs.repartition(3), 2), "other")
    assert first == slots(sharding.shard(docs.repartition(9), 2), "other") and len(first) == 2000
    with_map = docs.limit(20).withColumn("m", F.create_map(F.lit("a"), F.col("other")))
    assert sharding.shard(with_map, 2).count() == 20


def of_long(value, seed):
    """Spark's xxhash64 of a long under the seed so far."""
    h = xxhash.xxh64_intdigest(value.to_bytes(8, "little", signed=True), seed & (2**64 - 1))
    return h - 2**64 if h >= 2**63 else h


def of_int(value, seed):
    h = xxhash.xxh64_intdigest(value.to_bytes(4, "little", signed=True), seed & (2**64 - 1))
    return h - 2**64 if h >= 2**63 else h


def test_sharding_query_is_that_of_plain_hashes(spark, tmp_path):
    spark.createDataFrame([r for r in ROWS if r[0] is not None], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")

    def shard(doc_id, n):
        return max((of_int(i, of_int(0, of_long(doc_id, 42))), i) for i in range(n))[1]

    rows = llm.QUERIES["op1_sharding"](spark, str(tmp_path)).collect()
    assert len(rows) == len([r for r in ROWS if r[0] is not None])
    texts = {}
    for r in ROWS:
        texts.setdefault(r[0], r[1] or "")
    for r in rows:
        whole = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(whole) + 16, zlib.crc32(whole), "key")
        assert (r.shard, r.grown_shard) == (shard(r.doc_id, 40), shard(r.doc_id, 41))


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e6])
def test_weights_of_any_size(spark, scale):
    """Only the proportion of the weights counts; the ranges hold few rows each."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    weight = F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0)
    plain = {r.doc_id: r.copies for r in mixing.mix(docs, weight=weight).collect()}
    assert {r.doc_id: r.copies for r in mixing.mix(docs, weight=weight * F.lit(scale)).collect()} == plain
    ranges = docs.groupBy(mixing.key_range(mixing.sample_key(F.col("doc_id"), weight * F.lit(scale)))).count()
    assert ranges.agg(F.max("count")).first()[0] < 60


def test_weight_zero_is_never_drawn_and_null_is_one(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source"))
    weight = F.when(F.col("doc_id") % 3 == 0, 0.0).when(F.col("doc_id") % 3 == 1, F.lit(None).cast("double")).otherwise(1.0)
    rows = mixing.mix(docs.unionAll(docs.where("doc_id < 10")), weight=weight).collect()
    assert len(rows) == 3010 and all(r.copies == 1 for r in rows if r.doc_id % 3 == 0)
    assert sum(r.copies == 2 for r in rows) > 1000
    assert {r.doc_id: r.copies for r in mixing.mix(docs, weight=weight).collect()} == {
        r.doc_id: r.copies for r in mixing.mix(docs, weight=F.coalesce(weight, F.lit(1.0))).collect()}
    assert mixing.mix(docs, weight=F.lit(-1.0)).where("copies <> 1").count() == 0


def test_top_k_with_repeated_keys_short_vectors_and_other_columns(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i % 300), rng.normal(size=int(rng.integers(3, 7))).astype(np.float32).tolist()) for i in range(420)]
    rows += [(7, [3.0] * 6)] * 40 + [(7, [float(j), 5.0]) for j in range(30)]
    frame = spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], "vec_id long, embedding array<float>, score string, rank int").repartition(4)
    whole = [(i, [math.floor(256 * x) for x in v] + [0] * (6 - len(v))) for i, v in {(i, tuple(v)) for i, v in rows}]
    want = []
    for q in sorted({i for i, _ in whole if i % 50 == 0}):
        best = {}
        for i, a in whole:
            if i == q:
                for j, b in whole:
                    if j != q:
                        best[j] = max(best.get(j, -10**18), sum(x * y for x, y in zip(a, b)))
        want += [(q, n + 1, j, s) for n, (s, j) in enumerate(sorted((-s, j) for j, s in best.items())[:5])]
    want = [(q, n, j, -s) for q, n, j, s in want]
    for options in ({}, {"query_block": 3, "slice_rows": 60}):
        got = [tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 50 == 0, **options).orderBy("query_id", "rank").collect()]
        assert got == want


def test_bounds_leave_most_candidates_out(spark):
    """Vectors in clusters: the pivots tell most candidates apart from the best."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(40, 16)) * 4
    rows = [(i, (centers[i % 40] + rng.normal(size=16) * 0.1).tolist()) for i in range(4000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    counted = topk.evaluate(frame, F.col("vec_id") % 100 == 0, slice_rows=1000)
    total = counted.agg(F.sum("evaluated")).first()[0]
    assert 0 < total < 0.6 * 40 * 3999


def test_secrets_read_candidates_and_join_narrow_rows(spark):
    rows = [(i, f"plain {prose(i, 20)}", "c") for i in range(60)] + [(60, "token = abcdefghijklmnop", "c")] * 3 + [(None, "AKIA" + "Q" * 16, "c"), (None, None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, assign_spans string")
    found = secrets.scan(docs)
    assert found.columns[:2] == ["doc_id", "text"] and found.count() == len(rows)
    assert found.where("size(assign_spans) = 1").count() == 3 and found.where("size(access_spans) = 1").count() == 1
    plan = found.drop("text")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan


def test_contexts_are_read_over_the_whole_gap(spark):
    rng = random.Random(4)
    gap, long_word = " -" * 200, "w" * 90
    rows = [(i, f"reach {long_word} mailbox{gap} user{i}@site{rng.randrange(99)}.org now please") for i in range(12)]
    rows += [(100, f"reach {long_word} mailbox{gap} a@b now please"), (101, f"reach {long_word} nothing{gap} c@d never here")]
    found = {r.doc_id: r.context_spans for r in pii.extract(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [rows[12][1][s.start:s.end] for s in found[100]] == ["a@b"] and not found[101]


def test_limits_between_two_lengths(spark):
    lengths = [0, 0, 3, 3, 3, 10, 250, 251]
    counts = token_counts.histogram(spark.createDataFrame([(n,) for n in lengths], "tokens long"))
    wanted = [0, 1, 3, 7, 250, 10**6]
    found = {r.context_limit: r for r in token_counts.at_limits(counts, wanted).collect()}
    assert sorted(found) == wanted
    for limit, r in found.items():
        over = [n for n in lengths if n > limit]
        assert (r.documents_over, r.tokens_over, r.truncated_tokens) == (len(over), sum(over), sum(min(n, limit) for n in lengths))
        assert r.quantile == 1 - len(over) / len(lengths) and (r.total_documents, r.total_tokens) == (len(lengths), sum(lengths))
    for r in token_counts.limits(counts).collect():
        (same,) = token_counts.at_limits(counts, [r.context_limit]).collect()
        assert (same.documents_over, same.tokens_over, same.truncated_tokens, same.quantile) == (r.documents_over, r.tokens_over, r.truncated_tokens, r.quantile)
    (none,) = token_counts.at_limits(counts.limit(0), [5]).collect()
    assert (none.documents_over, none.truncated_tokens, none.quantile, none.total_documents) == (0, 0, None, 0)
