"""Phrase collocations against plain counting."""

import random
import re
import tracemalloc
from collections import Counter

import pytest

from lakejobs.llm import collocations
from tests.llm.test_operators import ROWS, SCHEMA

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
        words = re.findall("[^ \t]+", piece)
        if words:
            yield words


def gram_counts(rows):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for size in (1, 2, 3, 4):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i:i + size])] += 1
    return counts, totals


def brute(rows, least=30, first=2000):
    counts, totals = gram_counts(rows)
    found = {}
    for (lang, p), a in counts.items():
        if len(p) > 1 and a >= least:
            cuts = []
            for k in range(1, len(p)):
                l, r = counts[lang, p[:k]], counts[lang, p[k:]]
                cuts.append((2000000 * a // (l + r), k, l, r))
            found[lang, p] = (a, min(cuts))
    out = set()
    for lang in totals:
        ranked = []
        for (own, p), (a, (score, _, l, r)) in found.items():
            if own != lang:
                continue
            longer = [n for (o, q), (n, _) in found.items() if o == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if not any(100 * n >= 80 * a for n in longer):
                ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(ranked)[:first], 1):
            out.add((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return out


def result(df):
    rows = df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert len({(r.lang, r.rank) for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


def invented(seed):
    """Random words, long repeated passages, cycles, very frequent pairs and odd languages."""
    rng = random.Random(seed)
    words = [f"{c}{d}" for c in "abcÉß" for d in range(3)]
    passage = " ".join(f"p{i}" for i in range(40))
    rows = []
    for i in range(150):
        lang = rng.choice(["en", "de", None, "und", "", "x\ty"])
        rows.append((lang, " ".join(rng.choices(words, weights=range(1, 16), k=80)) + ". " + passage + rng.choice([" tail", ", tail", ""])))
        rows.append(("en", "Hot Pair " + " hot pair ".join(rng.choices(words, k=20)) + "!a b a b a b a b a\tb"))
    return rows + [("en", None), ("en", ""), ("en", " \t. ,\n"), (None, "solo"), ("en", "one two")] * 3


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "c", 1.0) for i, (lang, t) in enumerate(rows)], "n long, text string, lang string, phrase string, score double").repartition(3)


@pytest.mark.parametrize("hot", [False, True])
def test_equals_plain_counting(spark, monkeypatch, hot):
    """Small flushes, and words and pairs dealt to several tasks, change nothing."""
    rows = invented(5)
    if hot:
        monkeypatch.setattr(collocations, "hot_places", lambda *_: collocations.Hot({"en\thot": 5, "en\ta": 3, "und\ta0": 2}, {"en\thot pair": 7, "en\ta b": 4}))
    assert result(collocations.collocations(frame(spark, rows))) == brute(rows)


def test_frequent_places_are_found(spark):
    rows = [("en", " ".join(f"hot pair w{i} v{j}" for j in range(30))) for i in range(120)]
    hot = collocations.hot_places(frame(spark, rows), "lang", "text", 1)
    assert "en\thot" in hot.words and "en\thot pair" in hot.pairs and hot.pairs["en\thot pair"] > 1


def test_small_flushes_and_long_pieces():
    rows = invented(7)
    for places, long_text in ((10**7, 10**7), (50, 80)):
        kept, summed = collocations._Places(collocations.Hot()), Counter()
        old = collocations.PLACES, collocations.LONG_TEXT
        collocations.PLACES, collocations.LONG_TEXT = places, long_text
        try:
            batches = [b for lang, text in rows for b in kept.add(lang or "und", text or "")] + list(kept.flush())
        finally:
            collocations.PLACES, collocations.LONG_TEXT = old
        for batch in batches:
            for row in batch.to_pylist():
                lang, word = row["head"].rsplit("\t", 1)
                for tail in row["tails"].split("\t"):
                    *rest, n = tail.split(" ")
                    phrase = tuple(w for w in [word, *rest] if w)
                    for size in range(2 if rest else 1, len(phrase) + 1):
                        summed[lang, phrase[:size]] += int(n)
                    if not rest and not word:
                        summed[lang, None] += int(n)
        counts, totals = gram_counts([(lang or "und", t) for lang, t in rows])
        assert summed == counts + Counter({(lang, None): n for lang, n in totals.items()})


def test_a_flush_needs_few_bytes_for_each_place():
    """Two tasks flush at once beside the heap of their executor."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(5_000)]
    kept = collocations._Places(collocations.Hot({"en\tw1": 8}, {"en\tw1 w2": 8}))
    for _ in range(4):
        assert not list(kept.add("en", " ".join(rng.choices(words, k=50_000))))
    places = kept.size
    tracemalloc.start()
    for _ in kept.flush():
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 180 * places


def test_unary_paths_are_compacted(spark):
    rows = [("en", " ".join(f"p{i}" for i in range(25)))] * 31 + [("en", "p3 p4 p5 other")]
    found = collocations.counts(frame(spark, rows))
    paths = {(" ".join(r.words), r.c) for r in collocations.unary_paths(found).collect()}
    # The node p3 p4 p5 has a way out more, and a piece begins there.
    assert paths == {(" ".join(f"p{i}" for i in range(6)), 31), (" ".join(f"p{i}" for i in range(3, 25)), 31)}


def test_odd_and_empty_tables(spark):
    odd = spark.createDataFrame(ROWS * 30, SCHEMA)
    assert result(collocations.collocations(odd)) == brute([(r[2], r[1]) for r in ROWS * 30])
    assert result(collocations.collocations(odd.limit(0))) == set()
    big = spark.createDataFrame([("en", 4, "a b c d", 9 * 10**18), *[("en", n, p, 9 * 10**18) for n, p in ((1, "a"), (1, "d"), (2, "a b"), (2, "c d"), (3, "a b c"), (3, "b c d"))]],
                                "lang string, level int, phrase string, c long")
    assert {(r.phrase, r.score) for r in collocations.candidates(big).where("size = 4").collect()} == {("a b c d", 1000000)}
