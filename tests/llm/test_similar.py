"""The near-duplicate stage against all pairs of real documents, and its dealing."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakejobs.llm import simhash
from tests.conftest import MEDIUM
from tests.llm.test_operators import prose


def similarity(a, b):
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def all_links(sets, least=0.8):
    """All pairs of keys with at least this similarity, by looking up every shingle."""
    holders, links = {}, set()
    for key, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(key)
    for keys in holders.values():
        for a, b in combinations(keys, 2):
            if (a, b) not in links and similarity(sets[a], sets[b]) >= least:
                links.add((a, b))
    return links


def test_recall_of_links_on_documents(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    sets = {r.doc_id: set(simhash.shingle_set(r.text, 5).tolist()) for r in docs.collect()}
    links = all_links({k: s for k, s in sets.items() if s})
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, shingle=5, scheme=simhash.similar(0.8)).collect()}
    caught = sum(found[a] == found[b] for a, b in links)
    assert len(links) > 50 and caught >= 0.97 * len(links), (caught, len(links))
    # Nothing is joined without links: every component is one of the graph of all links.
    label = {k: k for k in sets}
    for _ in range(30):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    empty = min((k for k, s in sets.items() if not s), default=None)
    assert all(label[found[k]] == label[k] or not s and found[k] == empty for k, s in sets.items())


@pytest.mark.parametrize("two_sided", [False, True])
def test_set_links_join_all_similar_sets(two_sided):
    rng = random.Random(3)
    sets = []
    for i in range(60):
        base = [rng.getrandbits(64) for _ in range(rng.choice((1, 4, 5, 30, 200)))]
        for _ in range(rng.choice((1, 2, 5))):
            sets.append(np.unique(np.array([rng.getrandbits(64) if rng.random() < 0.08 else x for x in base], dtype=np.uint64)))
    sets.append(np.empty(0, np.uint64))
    side = np.array([rng.randrange(2) if two_sided else 0 for _ in sets])
    a, b = simhash.set_links(sets, side, 0.8)

    def components(pairs):
        label = list(range(len(sets)))
        for _ in range(len(sets)):
            for x, y in pairs:
                label[x] = label[y] = min(label[x], label[y])
        return label

    true = [(i, j) for i, j in combinations(range(len(sets)), 2) if len(sets[i]) and len(sets[j])
            and (not two_sided or side[i] != side[j]) and similarity(set(sets[i].tolist()), set(sets[j].tolist())) >= 0.8]
    found = list(zip(a.tolist(), b.tolist()))
    assert len(true) > 30 and {tuple(sorted(p)) for p in found} <= set(true) and components(found) == components(true)
    # Links span the components: no more than there are members.
    assert len(found) < len(sets)


def test_large_groups_are_compared_in_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP_ROWS", 8)
    rows = []
    for i in range(60):
        words = prose(5, 300).split()
        rng = random.Random(i)
        # Half are alike; half are candidates that are not alike.
        for at in rng.sample(range(300), 4 if i % 2 else 40):
            words[at] = f"own{i}x{at}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = {k: set(simhash.shingle_set(t, 5).tolist()) for k, t in rows}
    label = {k: k for k in sets}
    for _ in range(60):
        for a, b in all_links(sets):
            label[a] = label[b] = min(label[a], label[b])
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, shingle=5, scheme=simhash.similar(0.8)).collect()}
    assert found == label and len(set(label.values())) > 20


def test_hot_keys_do_not_depend_on_tasks(spark, monkeypatch):
    """A key with one row in each task is found; a sample finds the hottest."""
    monkeypatch.setattr(simhash, "PART_ROWS", 16)
    prints = spark.range(64).select("id", F.unhex(F.lpad(F.hex(F.col("id") * 2**40), 16, "0")).alias("fingerprint")).repartition(64)
    parts = simhash.hot_keys(prints, simhash.EXACT_64)
    whole = simhash.fingerprint("x", 4, 1)
    assert parts and max(parts.values()) >= 64 // 16 and len(whole) == 8
    monkeypatch.setattr(simhash, "SAMPLE_ROWS", 40)
    sampled = simhash.hot_keys(prints, simhash.EXACT_64)
    assert set(sampled) <= set(parts) and max(sampled.values()) >= 64 // 16 // 2


def test_keep_one_keeps_one_of_every_text(spark):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(2, b, 0), (5, b, 1), (5, a, 2), (5, a, 3), (7, c, 4), (2, c, 5), (None, a, 6), (9, None, 7), (9, "", 8), (9, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int").withColumn("component_id", F.lit("clash"))
    for scheme in (simhash.EXACT_64, simhash.similar(0.8)):
        kept = simhash.keep_one(docs, scheme=scheme)
        assert kept.columns == docs.columns
        found = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
        assert found == sorted([(False, 2, b), (False, 5, a), (False, 2, c), (True, 0, a), (False, 9, ""), (False, 9, ""), (False, 9, "")])
        assert kept.where("fingerprint = 7").collect()[0].text is None
    assert simhash.keep_one(docs.limit(0)).count() == 0
