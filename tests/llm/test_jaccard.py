"""Operator 2 against all pairs in plain Python, and its parts."""
import random
import re

import numpy as np
import pytest

from panelcast.llm import components as cc
from panelcast.llm import jaccard_join as J
from . import fixtures as fx

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            o = len(sets[i] & sets[j])
            if o and 100 * o >= percent * (len(sets[i]) + len(sets[j]) - o):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def chains(seed):
    """Copies of copies, so that components are wider than a link, around one hot base."""
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(500)]
    base = [r.choice(vocab) for _ in range(80)]
    out, texts = [], [base]
    for _ in range(140):
        w = list(r.choice(texts) if r.random() < 0.6 else base)
        for _ in range(r.randint(0, 3)):
            k = r.randrange(len(w))
            w[k:k + r.randint(0, 2)] = [r.choice(vocab) for _ in range(r.randint(0, 2))]
        texts.append(w)
    for i, w in enumerate(texts):
        out.append((20_000 + i, " ".join(x.upper() if r.random() < 0.1 else x for x in w)))
    return out


@pytest.fixture(scope="module")
def rows():
    out = ([(i, t) for i, t, *_ in fx.WEIRD] + [(1000 + i, t) for i, t in fx.prose(160, 8)]
           + [(3000 + i, t) for i, t in fx.prose(60, 9, words=(1, 12), vocabulary=6)] + chains(1))
    random.Random(0).shuffle(out)
    return out


@pytest.mark.parametrize("percent,unit,block", [(75, 2_000_000, 4_000_000), (75, 900, 600), (60, 2000, 4_000_000)])
def test_components_equal_brute_force(spark, rows, percent, unit, block):
    docs = spark.createDataFrame([(*x, "x", 1) for x in rows], "doc_id long, text string, id string, n int").repartition(4)
    got = {r.id: (r.n_shingles, r.component_id) for r in J.jaccard_components(
        docs, percent, unit_shingles=unit, task_shingles=2000, block_shingles=block).collect()}
    assert got == brute(rows, percent)


def test_repeated_rows_null_ids_and_empty(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(4, text), (4, text), (None, text.upper()), (2, text), (9, None), (None, ""), (8, " ")],
                                 "doc_id long, text string")
    got = sorted(((r.id is None, r.id or 0, r.n_shingles, r.component_id) for r in J.jaccard_components(docs).collect()),
                 key=repr)
    assert got == sorted([(False, 4, 3, 2), (False, 4, 3, 2), (True, 0, 3, 2), (False, 2, 3, 2), (False, 9, 0, 9),
                          (True, 0, 0, None), (False, 8, 0, 8)], key=repr)
    assert J.jaccard_components(fx.empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_block_join_equals_all_pairs(seed):
    r = random.Random(seed)
    sets = [set(r.sample(range(60), r.randint(1, 30)))]
    for _ in range(200):
        s = set(r.choice(sets))
        for _ in range(r.randint(0, 6)):
            s.discard(r.choice(sorted(s))) if len(s) > 1 and r.random() < 0.5 else s.add(r.randrange(60))
        sets.append(s)
    percent = r.choice([55, 75, 90])
    order = list(range(60))
    r.shuffle(order)
    prefixes = []
    for s in sets:
        own = sorted(s, key=order.index)
        prefixes.append(np.array(own[:len(own) - -(-percent * len(own) // 100) + 1]))
    join = J.BlockJoin(percent)
    roots = join.roots([len(s) for s in sets], prefixes, [np.array(sorted(s), np.uint64) for s in sets])
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if 100 * o >= percent * (len(sets[i]) + len(sets[j]) - o):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    assert [roots.index(x) for x in roots] == [[find(k) for k in range(len(sets))].index(find(i)) for i in range(len(sets))]


def test_answers_of_a_group_derive_from_its_pivot():
    """Near copies cost about one comparison each, not one per pair."""
    r = random.Random(2)
    base = set(range(200))
    sets = [base ^ set(r.sample(range(400), 6)) for _ in range(300)]
    ordered = [np.array(sorted(s), np.uint64) for s in sets]
    join = J.BlockJoin()
    roots = join.roots([len(s) for s in sets], [o.astype(np.int64)[:60] for o in ordered], ordered)
    assert len(set(roots)) == 1 and join.compared < 3 * len(sets)


def test_connected_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(r.randrange(100, 200), r.randrange(100, 200)) for _ in range(70)] + [(300, 300)]
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {x.node: x.root for x in cc.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in list(parent)}


def test_many_more_buckets_than_sixteen_bits_hold(spark, monkeypatch):
    """The number of buckets has no cap: ids stay distinct and results whole."""
    rows = fx.prose(120, 8)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, J.jaccard_components(df).drop("body").collect()))
    monkeypatch.setattr(J, "BUCKETS_PER_TASK", 20_011)  # 320,176 buckets
    assert sorted(map(tuple, J.jaccard_components(df).drop("body").collect())) == want
