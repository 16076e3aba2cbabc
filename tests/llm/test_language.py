"""Operator 10: held-out accuracy, filter properties, a plain version of the decision."""
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import language as L
from . import fixtures as fx

SYLLABLES = {"aa": "th er on an re he in ed nd ha".split(), "bb": "en er ch ei un ge ie sch ich die".split(),
             "cc": "que ci ón ar os la el ad es ra".split()}


def corpus(n, seed=0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        lang = r.choice(sorted(SYLLABLES))
        text = " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(8, 60)))
        out.append((i, text + r.choice(["", ".", " 12", "!\n"]), lang if r.random() < 0.9 else None, lang))
    return out


@pytest.fixture(scope="module")
def learned(spark):
    rows = corpus(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string")
    held = L.fold(F.col("doc_id")) == 2
    return rows, docs, L.learn(docs.filter(~held).select("lang", "text"))


def test_held_out_accuracy(learned):
    rows, docs, filters = learned
    truth = {r[0]: r[3] for r in rows}
    got = L.identify(docs, filters).collect()
    assert len(got) == len(rows)
    held = [r for r in got if zlib.crc32(str(r.id).encode()) % 4 == 2]
    assert len(held) > 50 and np.mean([truth[r.id] == r.lang_pred for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def plain_grams(text, n=L.GRAM):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    s = f" {' '.join(words)} "
    return [s[i:i + n] for i in range(len(s) - n + 1)] if words else []


def test_grams_do_not_depend_on_the_batch(learned):
    texts = [t or "" for _, t, *_ in fx.WEIRD] + [r[1] for r in learned[0][:60]]
    whole = {i: [] for i in range(len(texts))}
    for start, code, own in L.grams(texts):
        for i in np.unique(own):
            whole[start + int(i)] = code[own == i].tolist()
    for i, t in enumerate(texts):
        single = [c for _, code, _ in L.grams([t]) for c in code.tolist()]
        assert single == whole[i]
        if not any(0xD800 <= ord(c) for c in t):
            assert len(single) == len(plain_grams(t))


def test_masks_lose_no_language(learned):
    _, _, filters = learned
    rng = np.random.default_rng(0)
    code, lang = rng.integers(0, 2**63, 5000).astype(np.uint64), rng.integers(0, 5, 5000)
    f = L.Filters(list("abcde"), lang, code, 4)
    assert np.all(f.masks(code) >> lang.astype(np.uint64) & np.uint64(1))
    other = rng.integers(0, 2**63, 200_000).astype(np.uint64)
    for b in range(5):
        seen = np.mean(f.masks(other) >> np.uint64(b) & np.uint64(1))
        assert seen == pytest.approx(f.false_rate[b], abs=0.01)


def test_share_bounds_the_model(spark):
    docs = spark.createDataFrame([("x", " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}rare" for i in range(600)))],
                                 "lang string, text string")
    assert len(L.learn(docs, min_share=0.01).slots) <= 1 << 10


def test_every_label_is_kept(spark):
    """More labels than one mask word has bits, and than two words have."""
    def text(i):
        return " ".join(chr(0x4E00 + 30 * i + k) * 2 + chr(0x4E00 + 30 * i + k + 1) * 3 for k in range(25))
    names = [f"l{i:03}" for i in range(150)]
    filters = L.learn(spark.createDataFrame([(n, text(i)) for i, n in enumerate(names)], "lang string, text string"))
    assert filters.languages == names and filters.slots.shape[1] == 3
    docs = spark.createDataFrame([(i, text(i)) for i in range(150)], "doc_id long, text string")
    got = {r.id: (r.lang_pred, r.score) for r in L.identify(docs, filters).collect()}
    assert {i: got[i][0] for i in got} == dict(enumerate(names)) and min(s for _, s in got.values()) > 0.9


def test_edges(spark, learned):
    got = {r.id: r for r in L.identify(fx.weird(spark), learned[2]).collect()}
    for i, t, *_ in fx.WEIRD:
        has = any(map(str.isalpha, t or ""))
        assert (got[i].lang_pred != "und") == has
        assert has or got[i].score == 0
    assert L.identify(fx.empty(spark), learned[2]).count() == 0
    nothing = L.learn(fx.empty(spark).select("lang", "text"))
    assert {r.lang_pred for r in L.identify(fx.weird(spark), nothing).collect()} == {"und"}


def exact_sets(rows, min_share=L.MIN_SHARE):
    """The kept n-grams of every label, counted in plain Python."""
    counts = {}
    for text, lang in rows:
        if lang:
            own = counts.setdefault(lang, {})
            for g in plain_grams(text or ""):
                own[g] = own.get(g, 0) + 1
    return {lang: {g for g, n in own.items() if n >= sum(own.values()) * min_share} for lang, own in counts.items() if own}


def test_decision_equals_exact_sets(learned):
    """A plain version of the decision, with sets in place of the filters: the same label
    wherever it is clear of the filters' false positives, and nearly the same score."""
    rows, docs, filters = learned
    sets = exact_sets([(t, lang) for i, t, lang, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2])
    assert sorted(sets) == filters.languages
    compared = 0
    for r in L.identify(docs, filters).collect():
        grams = plain_grams(rows[r.id][1])
        shares = sorted(((sum(g in sets[lang] for g in grams) / len(grams), lang) for lang in sets), reverse=True)
        assert abs(r.score - shares[0][0]) < 0.1
        if shares[0][0] - shares[1][0] > 0.1:
            assert r.lang_pred == shares[0][1]
            compared += 1
    assert compared > 300


def test_null_ids_repeated_rows_and_empty_labels(spark, learned):
    rows = [(None, "then her one", "aa"), (None, "then her one", "aa"), (5, "sch ich die", ""), (5, "sch ich die", ""),
            (6, None, None), (7, "que los adelos", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(((r.id, r.lang_pred, round(r.score, 6)) for r in L.identify(docs, learned[2]).collect()), key=repr)
    assert [g[0] for g in got] == sorted([r[0] for r in rows], key=repr)
    assert got.count(next(g for g in got if g[0] is None)) == 2 and got.count(next(g for g in got if g[0] == 5)) == 2
    assert L.learn(docs.select("lang", "text")).languages == ["aa"]  # an empty label is none, with text or without
