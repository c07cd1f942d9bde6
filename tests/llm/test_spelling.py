"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lakejobs.llm import queries as llm
from lakejobs.llm import spelling
from tests.conftest import SMALL
from tests.llm.test_operators import ROWS, SCHEMA

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(rows):
    """Counts of the words of (doc_id, text), by the letter of the contract."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    small, large = sorted((a, b), key=len)
    return len(large) == len(small) + 1 and any(large[:i] + large[i + 1:] == small for i in range(len(large)))


def brute(rows):
    words = words_of(rows)
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    found = {}
    for w, n in words.items():
        close = [v for size in (len(w) - 1, len(w), len(w) + 1) for v in by_size.get(size, []) if v != w and near(w, v)]
        best = min(close, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        found[w] = [form, None, n, len(close), words[form] if form else None]
    for w, row in found.items():
        at = w
        while found[at][0]:
            at = found[at][0]
        row[1] = at
    return {(w, *row) for w, row in found.items()}


def result(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r.word for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


def invented(seed):
    """Rows with words at all distances, ties, chains of forms, accents and long runs."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abeé×x") for _ in range(rng.choice((4, 5, 6, 7)))) for _ in range(150)]
    base += ["lllll", "llllll", "lllllll", "x" * 70, "x" * 71, "x" * 69 + "y", "a" * 3000, "a" * 2999 + "ÿ"]
    rows = [(i, " ".join(rng.choices(base, weights=[2 ** (j % 9) for j in range(len(base))], k=60))) for i in range(120)]
    rows += [(900, "stonex " * 30 + "stoney " * 70 + "stvney " * 200 + "stvnez " * 500)]
    rows += [(None, None), (None, "lllll LLLLL lllll"), (5, ""), (5, "a" * 3000 + " ABCDE École école"), (5, "a" * 3000)]
    return rows


@pytest.mark.parametrize("options", [{}, {"filter_bytes": 64, "word_bits": 4}])
def test_equals_all_pairs(spark, options):
    """Crowded filters and several slices change what is shuffled, not the result."""
    rows = invented(3)
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    expected = brute(rows)
    assert any(r[0] == "stonex" and r[2] not in (r[0], r[1]) for r in expected), "a chain of two forms"
    assert result(spelling.variants(docs, **options)) == expected


def test_query_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert result(llm.QUERIES["op13_spelling"](spark, SMALL)) == brute(rows)


def test_odd_and_empty_tables(spark):
    odd = spark.createDataFrame(ROWS * 3, SCHEMA)
    assert result(spelling.variants(odd)) == brute([(r[0], r[1]) for r in ROWS * 3])
    assert result(spelling.variants(odd.limit(0))) == set()


def test_hashes_of_edits_are_those_of_the_words_they_give():
    words = ["abcde", "llama", "ééééé", "zzzzÿ"]
    seen = set()
    for keys, row, place, letter in spelling.edits(spelling._letters(words, 5)):
        out = []
        for r, p, x in zip(row.tolist(), place.tolist(), letter.tolist()):
            out.append(words[r][:p] + (spelling.LETTERS[x] if x >= 0 else "") + words[r][p + 1:])
            seen.add((words[r], out[-1]))
        assert np.array_equal(spelling.hashes(out), keys)
    for w in words:
        assert {v for u, v in seen if u == w and len(v) == 4} == {w[:i] + w[i + 1:] for i in range(5)}


def test_filters_hold_all_words_and_let_few_others_pass():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 50_000).astype(np.uint64)
    mixed = spelling._mix(keys)
    blocks = np.zeros((-(-len(keys) * spelling.WORD_BITS // 512), 8), np.uint64)
    at, bits = spelling._block(mixed, len(blocks)), spelling._bits(mixed)
    for lane in range(8):
        np.bitwise_or.at(blocks[:, lane], at, bits[:, lane])
    assert len(spelling.passing(keys, blocks, 1, 0)) == len(keys)
    assert len(spelling.passing(rng.integers(0, 2**63, 300_000).astype(np.uint64), blocks, 1, 0)) < 0.005 * 300_000
