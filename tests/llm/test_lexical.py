"""Ranked lexical search against a plain scoring of every document."""
import math
import random
import re

import numpy as np
import pytest

from panelcast.llm import lexical
from panelcast.llm.lexical import DocumentTrie, lexical_search, parts, terms_of

from .fixtures import WEIRD, empty, prose, weird

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ITEMS = "item_id long, text string, id string, score long"


def plain(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top):
    held = [(i, w) for i, w in ((i, plain(t)) for i, t in docs) if w]
    n_docs, n_words = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for i, w in held:
            m, score = 75 + 25 * len(w) * n_docs // n_words, 0
            for t in plain(text):
                if tf := w.count(t):
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (
                        10**9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(sorted(scores, key=lambda r: (r[0], r[1], r[2] or 0))[:top], 1)]
    return sorted(out, key=repr)


def run(spark, docs, items, top=5):
    frame = docs if hasattr(docs, "columns") else spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in items], ITEMS)
    return sorted((tuple(r) for r in lexical_search(frame, asked, top).collect()), key=repr)


def test_equals_plain_scoring(spark, monkeypatch):
    monkeypatch.setattr(lexical, "TREE_POSTINGS", 3000)  # several tries a task
    docs = prose(400, 3)
    r = random.Random(1)
    items = [(k, " ".join(r.choice(docs)[1].split()[:30])) for k in range(12)] + [(50, "zzz none"), (51, "a a a B b")]
    assert run(spark, docs, items, 7) == brute(docs, items, 7)


def test_awkward_rows(spark):
    rows = [(i, t) for i, t, *_ in WEIRD] + [(None, "one word"), (500, "one word"), (500, "one word"), (7, "line")]
    items = [(1, "ONE one Word"), (2, None), (3, ""), (4, "中文 文字 ÉÉ é"), (5, "привет Привет"), (6, "line a b x")]
    frame = weird(spark, [(None, "one word", None, None), (500, "one word", "", ""), (500, "one word", "", ""),
                          (7, "line", "de", "a")])
    assert run(spark, frame, items) == brute(rows, items, 5)
    assert run(spark, frame, [(1, "one"), (1, "one")]) == brute(rows, [(1, "one")], 5)


def test_empty_tables_and_ties(spark):
    assert run(spark, empty(spark), [(1, "one")]) == []
    assert run(spark, [(1, "one")], []) == [] and run(spark, [(1, "  ,.")], [(1, "one")]) == []
    docs = [(i, "same text here") for i in range(90)] + [(100 + i, "other words") for i in range(30)]
    items = [(1, "same here"), (2, "other"), (3, "same other")]
    assert run(spark, docs, items, 20) == brute(docs, items, 20)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 3)
    docs = prose(60, 5)
    items = [(k, t[:80]) for k, t in docs[:8]]
    assert run(spark, docs, items, 3) == brute(docs, items, 3)


def test_terms():
    for _, text, *_ in WEIRD:
        assert [t.decode() for t in terms_of(text)] == plain(text)


@pytest.mark.parametrize("leaf,n", [(1, 200), (4, 500), (64, 1000), (64, 10)])
def test_trie_bounds_hold_and_search_is_exact(leaf, n):
    rng = np.random.default_rng(n + leaf)
    width = 30
    lengths = rng.integers(0, 12, n)
    doc = np.repeat(np.arange(n), lengths)
    rank = np.concatenate([np.sort(rng.choice(width, k, replace=False)) for k in lengths])
    tf = rng.integers(1, 5, len(doc))
    ids, m = rng.permutation(n), rng.integers(75, 300, n)
    trie = DocumentTrie(ids, m, doc, rank, tf, width, leaf)
    terms, weight = np.array([0, 3, 7, 29]), np.array([10, 500, 2000, 7000])
    dense = np.zeros((n, width), np.int64)
    dense[doc, rank] = tf
    truth = parts(weight, dense[:, terms], m[:, None]).sum(1)
    by_id = dict(zip(ids.tolist(), truth.tolist()))
    bound = trie.bounds(np.arange(len(trie.first)), terms, weight)
    for k, (a, b) in enumerate(zip(trie.first, trie.last)):
        assert all(by_id[i] <= bound[k] for i in trie.ids[a:b].tolist())
    for top in (1, 9, n):
        found, scores = trie.search(terms, weight, top)
        want = sorted((-s, i) for i, s in by_id.items() if s > 0)[:top]
        assert [(-s, i) for i, s in zip(found.tolist(), scores.tolist())] == want


def test_trie_of_repeated_and_deep_paths():
    # 3,000 equal vectors and a long chain of growing ones.
    # (a chain deeper than Python's own stack)
    doc = np.concatenate([np.repeat(np.arange(3000), 5), np.repeat(3000 + np.arange(1500), np.arange(1, 1501))])
    rank = np.concatenate([np.tile(np.arange(5), 3000), *[np.arange(k) for k in range(1, 1501)]])
    trie = DocumentTrie(np.arange(4500), np.full(4500, 100), doc, rank, np.ones(len(doc), np.int64), 2000)
    found, _ = trie.search(np.arange(1500), np.ones(1500, np.int64), 2)
    assert found.tolist() == [4499, 4498]
