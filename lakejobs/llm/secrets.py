"""Secret scans: a trigram index of the texts picks candidates of each rule, expressions verify them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import stored, whole_text, without
from lakejobs.llm.spans import empty_spans, spans
from lakejobs.llm.trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches; of them those stay whose ``measure`` group has at least ``least`` characters."""

    kind: str
    pattern: str
    measure: int = 0
    least: int = 0


BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # Runs of 16 and more are the runs of any length that pass the length test: a run is taken whole.
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Published formats of keys and tokens beyond the base kinds.
FORMAT_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("repository_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("service_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("payment_key", r"sk_live_[0-9A-Za-z]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + FORMAT_RULES


def index_trigrams(rules: Sequence[Rule]) -> list[str]:
    """Trigrams that the queries of ``rules`` ask for, in order."""
    return sorted({t for rule in rules for clause in trigram_query(rule.pattern) for grams in clause for t in grams})


def postings(docs: DataFrame, trigrams: Sequence[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Inverted index: a row (trigram, key, text_hash) for each indexed trigram a whole text holds, lower case."""
    listed = F.array(*[F.lit(t) for t in trigrams])
    folded = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.lower(whole_text(text)).alias("folded"))
    return folded.select("key", "text_hash", F.explode(F.filter(
        listed, lambda t: F.contains(F.col("folded"), t))).alias("trigram"))


def candidates(index: DataFrame, rules: Sequence[Rule], trigrams: Sequence[str]) -> DataFrame:
    """(key, text_hash, rules): texts whose postings satisfy the query of at least one rule.

    Postings of a text meet as one set of bits; a query holds where for each
    clause all bits of one of its trigram sets are there.
    """
    position = {t: i for i, t in enumerate(trigrams)}
    words = range(-(-len(trigrams) // 63))
    bit = F.element_at(F.map_from_arrays(F.array(*[F.lit(t) for t in trigrams]), F.array(*[F.lit(i) for i in range(len(trigrams))])), F.col("trigram"))
    place = index.withColumn("at", bit)
    sets = place.groupBy("key", "text_hash").agg(*[
        F.bit_or(F.when(F.floor(F.col("at") / 63) == w, F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col("at"), F.lit(63)))).otherwise(
            F.lit(0).cast("long"))).alias(f"bits{w}") for w in words])

    def holds(grams: frozenset[str]) -> Column:
        wanted = [sum(1 << (position[t] % 63) for t in grams if position[t] // 63 == w) for w in words]
        return _all([F.col(f"bits{w}").bitwiseAND(F.lit(m)) == F.lit(m) for w, m in zip(words, wanted) if m])

    hits = [F.when(_all([_any([holds(g) for g in sorted(clause, key=sorted)]) for clause in sorted(query, key=str)]), F.lit(rule.kind))
            for rule in rules if (query := trigram_query(rule.pattern))]
    found = sets.select("key", "text_hash", F.array_compact(F.array(*hits)).alias("rules"))
    return found.where(F.size("rules") > 0)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def rule_spans(rule: Rule, text: Column) -> Column:
    """Verified spans of one rule in a text."""
    found = spans(text, rule.pattern)
    if not rule.least:
        return found
    if not rule.measure:
        return F.filter(found, lambda s: F.length(s["match"]) >= rule.least)
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.measure))
    return F.filter(found, lambda s, i: F.length(F.get(measured, i)) >= rule.least)


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one array column ``<kind>_spans`` of (start, end, match) for each rule.

    Rules with mandatory trigrams read only texts the index gives for them; rules
    without any read every text. Offsets are code points, end exclusive. Null
    texts count as empty and have no span; index rows are held by key and hash of
    the text, so null or repeated keys keep apart by text and repeated rows all get
    their spans; an empty table gives no rows; columns of ``docs`` named like the
    new ones are replaced.
    """
    names = [f"{rule.kind}_spans" for rule in rules]
    docs = without(docs, *names)
    indexed = [rule for rule in rules if trigram_query(rule.pattern)]
    body, hashed = whole_text(text), docs.withColumn("__text_hash", F.xxhash64(text))
    # Rules that read every text are done in the scan, before any join.
    whole = hashed.select("*", *[rule_spans(rule, body).alias(name) for rule, name in zip(rules, names) if rule not in indexed])
    listed = [F.col(f"`{c}`") for c in docs.columns]
    if not indexed:
        return whole.select(*listed, *[F.col(n) for n in names])
    trigrams = index_trigrams(indexed)
    index = stored(postings(docs, trigrams, key, text), "trigram-postings")
    # Written, so that their measured size decides whether they are sent to the texts or meet them in a shuffle.
    found = stored(candidates(index, indexed, trigrams).select(
        F.col("key").alias("__key"), F.col("text_hash").alias("__hash"), F.col("rules").alias("__rules")), "trigram-candidates")
    texts = hashed.select(F.col(key).alias("__doc"), "__text_hash", body.alias("__body")).join(
        found, F.col("__text_hash").eqNullSafe(F.col("__hash")) & F.col("__doc").eqNullSafe(F.col("__key")))
    verified = [F.when(F.array_contains("__rules", rule.kind), rule_spans(rule, F.col("__body"))).otherwise(empty_spans()).alias(f"{rule.kind}_spans")
                for rule in indexed]
    # Rows that repeat key and text have equal spans: one of each is joined back, without the text.
    some = stored(texts.select("__key", "__hash", *verified).dropDuplicates(["__key", "__hash"]), "secret-spans")
    joined = whole.join(some, F.col("__text_hash").eqNullSafe(F.col("__hash")) & F.col(key).eqNullSafe(F.col("__key")), "left")
    return joined.select(*listed, *[
        (F.coalesce(F.col(n), empty_spans()) if rule in indexed else F.col(n)).alias(n) for rule, n in zip(rules, names)])
