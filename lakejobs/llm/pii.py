"""Personal data by bootstrapped contextual extraction.

Base expressions give seed entities. The words around the seeds are lexical
patterns; Spark scores the graph of patterns and instances in rounds; instances
that only trusted patterns surround are new identifiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import stored, whole_text, without
from lakejobs.llm.spans import digits, kept, luhn, spans

KINDS = ("email", "ip", "card", "phone")
# A run is entered only at its first character or where the last match ended: elsewhere no match can begin
# that the first character does not give. Possessive repeats then keep every search linear in the text.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Identifier-like words: those that hold a digit or an at sign.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: Numbers written in groups with single blanks between them.
GROUPS = r"(?<![^\x20\x09-\x0D])[+(]?[0-9][0-9().-]*+(?:\x20[(]?[0-9][0-9().-]*+)++(?![^\x20\x09-\x0D,;:!?])"


def _ip(match: Column) -> Column:
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False))


def _card(match: Column) -> Column:
    number = digits(match)
    return F.length(number).between(13, 19) & luhn(number)


def _phone(match: Column) -> Column:
    return F.length(digits(match)).between(9, 15)


def base_spans(text: Column) -> dict[str, Column]:
    """Verified spans of the base kinds in a text that is not null."""
    empty = F.array().cast("array<struct<start:int,end:int,match:string>>")
    return {
        "email": F.when(F.contains(text, F.lit("@")), spans(text, EMAIL)).otherwise(empty),
        "ip": kept(spans(text, IP), _ip),
        "card": kept(spans(text, CARD), _card),
        "phone": F.when(F.contains(text, F.lit("+")), kept(spans(text, PHONE), _phone)).otherwise(empty),
    }


def _identity(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), r"^[^\p{L}0-9+]+|[^\p{L}0-9]+$", "")


def _instance(match: Column, kind: Column) -> Column:
    """What two places of one identifier share: case does not count, nor do signs and blanks in numbers of several groups."""
    number = F.concat(F.when(F.startswith(match, F.lit("+")), "+").otherwise(""), digits(match))
    return F.when(kind.isin("card", "phone") | (kind.isNull() & F.contains(match, F.lit(" "))), number).otherwise(_identity(match))


def _between(start: Column, end: Column) -> Column:
    return F.substring(F.col("body"), start + 1, end - start)


def _seed_kind(word: Column) -> Column:
    """Kind of a word that is itself a base entity, else null."""
    octet = r"(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]))"
    return (F.when(F.regexp_like(word, F.lit(r"^[a-z0-9._%+-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)+$")), "email")
            .when(F.regexp_like(word, F.lit(rf"^{octet}(?:\.{octet}){{3}}$")), "ip")
            .when(F.regexp_like(word, F.lit(r"^\+[0-9][().0-9-]+[0-9]$")) & _phone(word), "phone")
            .when(F.regexp_like(word, F.lit(r"^[0-9][0-9-]*[0-9]$")) & _card(word), "card"))


def _apart(found: Column, taken: Column) -> Column:
    """Spans that share no character with a taken one."""
    return F.filter(found, lambda x: ~F.exists(taken, lambda y: (y["start"] < x["end"]) & (y["end"] > x["start"])))


def _first(found: Column) -> Column:
    """Sorted spans without those that begin inside an earlier kept one."""
    nothing = F.array().cast("array<struct<start:int,end:int,kind:string,match:string>>")
    return F.aggregate(
        found, F.struct(F.lit(0).alias("at"), nothing.alias("kept")),
        lambda acc, x: F.when(x["start"] < acc["at"], acc).otherwise(F.struct(
            x["end"].alias("at"), F.concat(acc["kept"], F.array(x)).alias("kept"))),
        lambda acc: acc["kept"])


def _as(found: Column, kind: str | None) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).cast("string").alias("kind"), s["match"].alias("match")))


#: Characters that an identifier has at least: numbers of one or two digits stand in all contexts and say nothing.
SHORTEST = 3


def occurrences(docs: DataFrame, key: str, text: str, shortest: int = SHORTEST) -> DataFrame:
    """Base entities and identifier-like words with their contexts: (key, text_hash, start, end, instance, seed, pattern).

    The base spans are the seeds, blanks and glued labels or not; of overlapping
    ones the first counts. Beside them stand numbers in groups of 7 to 19 digits and
    words without a blank that touch none of these. Each has two patterns:
    the two words before it, and the words on both sides, as far as its neighbours.
    Identifiers of fewer than ``shortest`` characters are left out.
    """
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), whole_text(text).alias("body"))
    found = rows.select(
        "key", "text_hash", "body", F.array_sort(F.concat(*[_as(s, kind) for kind, s in base_spans(F.col("body")).items()])).alias("base"),
        _as(kept(spans(F.col("body"), GROUPS), lambda m: F.length(digits(m)).between(7, 19)), None).alias("groups"),
        _as(spans(F.col("body"), TOKEN), None).alias("tokens"))
    seeds = found.select("key", "text_hash", "body", _first(F.col("base")).alias("seeds"), "groups", "tokens")
    taken = seeds.select("key", "text_hash", "body", "tokens", F.concat("seeds", _apart(F.col("groups"), F.col("seeds"))).alias("taken"))
    every = taken.select("key", "text_hash", "body", F.array_sort(F.concat("taken", _apart(F.col("tokens"), F.col("taken")))).alias("every"))
    # The text to both sides is cut out before the rows are unfolded, so that no row carries the whole text.
    sides = every.select("key", "text_hash", F.transform("every", lambda x, i: F.struct(
        x.alias("span"),
        _between(F.coalesce(F.get("every", i - 1)["end"], F.lit(0)), x["start"]).alias("left"),
        _between(x["end"], F.coalesce(F.get("every", i + 1)["start"], F.length("body"))).alias("right"))).alias("every"))
    # explode would have its array tested for rows first, and thus all of it computed twice over.
    words = sides.select("key", "text_hash", F.explode_outer("every").alias("one")).where(F.col("one").isNotNull()).select("key", "text_hash", "one.*")
    left, right = F.col("left"), F.col("right")
    # The words of the whole gap, however long it or a word of it is; a gap is the text between two neighbours.
    near = F.filter(F.split(F.regexp_replace(F.lower(left), r"[^\p{L}]+", " "), " "), lambda w: w != "")
    following = F.regexp_extract(F.lower(right), r"^[^\p{L}]*+(\p{L}*+)", 1)
    word = words.select(
        "key", "text_hash", F.col("span.start").alias("start"), F.col("span.end").alias("end"),
        _instance(F.col("span.match"), F.col("span.kind")).alias("instance"), F.col("span.kind").alias("base"),
        F.coalesce(F.get(F.reverse(near), F.lit(0)), F.lit("")).alias("one"),
        F.coalesce(F.get(F.reverse(near), F.lit(1)), F.lit("")).alias("two"),
        following.alias("next"))
    named = word.where(F.length("instance") >= shortest).withColumn("seed", F.coalesce(F.col("base"), _seed_kind(F.col("instance"))))
    return named.select("key", "text_hash", "start", "end", "instance", "seed", F.explode(F.array(
        F.concat_ws(" ", F.lit("before"), "two", "one"), F.concat_ws(" ", F.lit("around"), "one", F.lit("_"), "next"))).alias("pattern"))


def discovered(seen: DataFrame, rounds: int = 3, confidence: float = 0.8, support: int = 3) -> DataFrame:
    """(instance, kind, score) of unseeded instances that trusted patterns surround.

    Starting from the seeds, a round scores a pattern for a kind by the mean score
    of the distinct instances in it, if their scores add up to ``support``, and
    an instance by its best pattern. Scores under ``confidence`` count as none.
    The graph has one edge for each distinct (pattern, instance), so frequent
    contexts and identifiers are summed before they are joined.
    """
    graph = stored(seen.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-graph")
    degree = graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances")).where(F.col("instances") >= support)
    seeds = graph.where(F.col("seed").isNotNull()).select("instance", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    edges = stored(graph.join(degree, "pattern"), "pii-edges")
    known = seeds
    for _ in range(rounds):
        trusted = edges.select("pattern", "instance", "instances").join(known, "instance").groupBy("pattern", "kind", "instances").agg(
            F.sum("score").alias("mass")).where((F.col("mass") >= support) & (F.col("mass") / F.col("instances") >= confidence)).select(
            "pattern", "kind", (F.col("mass") / F.col("instances")).alias("trust"))
        reached = edges.where(F.col("seed").isNull()).select("pattern", "instance").join(trusted, "pattern").groupBy(
            "instance", "kind").agg(F.max("trust").alias("score"))
        known = stored(seeds.unionByName(reached), "pii-known")
    return known.join(seeds.select("instance").distinct(), "instance", "left_anti")


def of_kind(context: Column, kind: str) -> Column:
    """The discovered spans of one kind."""
    return F.filter(context, lambda s: s["kind"] == kind)


def extract(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = 3, confidence: float = 0.8,
            support: int = 3, shortest: int = SHORTEST) -> DataFrame:
    """``docs`` with ``<kind>_spans`` of the base kinds and ``context_spans`` (start, end, kind) of discovered ones.

    Offsets are code points, end exclusive. Null texts count as empty; spans of
    discovered identifiers are held by key and hash of the text, so null and
    repeated keys keep apart by text and repeated rows all get theirs; an empty
    table gives no rows; columns of ``docs`` named like the new ones are replaced.
    """
    names = [f"{k}_spans" for k in KINDS] + ["context_spans"]
    docs = without(docs, *names)
    seen = stored(occurrences(docs, key, text, shortest), "pii-seen")
    new = discovered(seen, rounds, confidence, support)
    places = seen.where(F.col("seed").isNull()).select("key", "text_hash", "start", "end", "instance").distinct().join(new, "instance")
    by_text = places.groupBy("key", "text_hash").agg(F.array_sort(F.collect_set(F.struct("start", "end", "kind"))).alias("__context"))
    body = whole_text(text)
    based = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.xxhash64(text).alias("__text_hash"),
                        *[found.alias(f"{k}_spans") for k, found in base_spans(body).items()])
    joined = based.join(by_text, F.col("__text_hash").eqNullSafe(F.col("text_hash")) & F.col(key).eqNullSafe(by_text["key"]), "left")
    nothing = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], *[F.col(f"{k}_spans") for k in KINDS],
                         F.coalesce(F.col("__context"), nothing).alias("context_spans"))
