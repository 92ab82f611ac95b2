import random
import re

import numpy as np
import pytest
from frames import TEXTS, documents, empty

from tidemark.llm import jaccard
from tidemark.llm.queries import op11_jaccard_join
from tidemark.llm.shared import read_table


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < size else zip(*(words[i:] for i in range(size))))


def slow(rows):
    """All pairs of different sets that share a shingle, compared as sets."""
    sets = {}
    for i, text in rows:
        sets.setdefault(shingles(text), []).append(i)
    sets.pop(frozenset(), None)
    listed = list(sets)
    root = list(range(len(listed)))

    def top(a):
        while root[a] != a:
            a = root[a]
        return a

    by_token = {}
    for a, s in enumerate(listed):
        for t in s:
            by_token.setdefault(t, []).append(a)
    pairs = set()
    for owners in by_token.values():
        pairs.update((a, b) for n, a in enumerate(owners) for b in owners[n + 1 :])
    for a, b in pairs:
        both = len(listed[a] & listed[b])
        if 100 * both >= 80 * (len(listed[a]) + len(listed[b]) - both):
            root[top(a)] = top(b)
    least = {}
    for a, s in enumerate(listed):
        ids = [i for i in [*sets[s], least.get(top(a))] if i is not None]
        least[top(a)] = min(ids, default=None)
    place = {s: a for a, s in enumerate(listed)}
    return [(i, len(s), least[top(place[s])] if s else i) for i, t in rows for s in [shingles(t)]]


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, v or 0) for v in r))


def families(seed, copies=40):
    """Families of edited copies, chains, and documents that share a long passage only."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    out = []
    passage = [word() for _ in range(60)]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([1, 4, 5, 6, 9, 30, 120, 300]))]
        for _ in range(rng.randrange(1, copies)):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    for _ in range(60):
        own = [word() for _ in range(rng.randrange(5, 120))]
        cut = rng.randrange(len(own))
        out.append("  ".join(own[:cut] + passage + own[cut:]))
    chain = [word() for _ in range(100)]
    for _ in range(30):
        chain = chain[2:] + [word(), word()]
        out.append("\n".join(chain))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert in_order(op11_jaccard_join(spark, sf_dir).collect()) == in_order(slow(rows))


@pytest.mark.parametrize("seed, frequent", [(1, 16), (2, 2)])
def test_families_equal_brute_force(spark, monkeypatch, seed, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    rows = TEXTS + [(1000 + n, t) for n, t in enumerate(families(seed))]
    found = jaccard.jaccard_components(documents(spark, rows).repartition(9))
    assert in_order(found.collect()) == in_order(slow(rows))


def test_large_groups_are_dealt_to_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SHARE", 300)
    rows = [(n, t) for n, t in enumerate(families(3))]
    assert in_order(jaccard.jaccard_components(documents(spark, rows)).collect()) == in_order(slow(rows))


def test_prefixes_meet_for_all_linked_pairs():
    rng = random.Random(9)
    for _ in range(3000):
        x = set(rng.sample(range(60), rng.randrange(1, 40)))
        y = set(x)
        for _ in range(rng.randrange(5)):
            y ^= {rng.randrange(60)}
        small, large = sorted([x, y], key=len)
        both = len(x & y)
        if not y or 100 * both < 80 * len(x | y):
            continue
        least = jaccard.needed(len(x) + len(y), 80)
        assert both >= least
        probe = int(jaccard.probe_length(np.array([len(large)]), 80)[0])
        index = len(small) - jaccard.needed(2 * len(small), 80) + 1
        assert set(sorted(large)[:probe]) & set(sorted(small)[:index])


def test_a_chunk_finds_all_partners():
    rng = random.Random(10)
    for _ in range(300):
        members = [np.unique(np.array(rng.sample(range(50), rng.randrange(1, 30)), np.uint64)) for _ in range(6)]
        query = np.unique(np.array(rng.sample(range(50), rng.randrange(1, 30)), np.uint64))
        found = jaccard.Chunk(list(range(6)), members).linked(query, 50).tolist()
        linked = [k for k, m in enumerate(members) if 100 * len(np.intersect1d(m, query)) >= 50 * len(np.union1d(m, query))]
        assert found == linked


def test_a_hash_for_two_sets_is_refused(spark):
    keys = spark.createDataFrame([(1, 5, 5), (2, 6, 7)], "key bigint, low bigint, high bigint")
    jaccard.refuse_collisions(keys.where("key = 1"), 0)
    with pytest.raises(jaccard.CollisionError):
        jaccard.refuse_collisions(keys, 0)


def test_empty_table_and_no_words(spark):
    assert jaccard.jaccard_components(empty(spark)).count() == 0
    rows = [(1, None), (2, ""), (None, " \n")]
    assert in_order(jaccard.jaccard_components(documents(spark, rows)).collect()) == in_order([(1, 0, 1), (2, 0, 2), (None, 0, None)])
