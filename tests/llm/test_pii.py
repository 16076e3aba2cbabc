"""Personal data: base spans against the plain patterns, the model against planted votes
and labelled text, and the query against a whole plain run."""
import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from panelcast.llm import pii
from panelcast.llm.queries import QUERIES

from .fixtures import WEIRD, empty, prose, weird

SF = "/root/testdata/sf0.001"
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and plain_luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    r = random.Random(7)
    bits = ["@", ".", "a", "B9", "-", " ", "+", "(", ")", "1", "22", "255", "256", "4111111111111111", "é", "\n", "_",
            "a@b.c", "1.2.3.4", "%", "+1 (555) 555-0100", "4111 1111-1111 1111", "٣", "中"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 25))) for _ in range(20_000)]
    texts += [t for _, t, *_ in WEIRD if t and len(t) < 5000] + ["a@b.c@d.e.f@g.h", "x@@y.z", "@a.b", "1.2.3.4.5.6.7.8",
                                                                "0001.02.3.0255", "1234567890123456789012345", "a@b..c"]
    for t in texts:
        assert pii.base_spans(t) == plain_base(t), t


@pytest.mark.parametrize("text", ["x" * 400_000, "1" * 400_000, "a@" * 200_000, "1." * 200_000, "+1" + " " * 400_000,
                                  "+1 " * 130_000, "1 " * 200_000, "a.b" * 100_000 + "@", ":" * 300_000, "a:" * 150_000,
                                  " dot " * 80_000, "x at y " * 60_000 + " dot ", "[at]" * 100_000, "(1) 111 " * 50_000])
def test_long_texts_take_linear_time(text):
    t0 = time.perf_counter()
    pii.candidates(text)
    assert time.perf_counter() - t0 < 20


def test_em_recovers_planted_reliabilities():
    rng = np.random.default_rng(3)
    share, n = 0.3, 40_000
    says = np.array([[[.8, .15, .05], [.1, .2, .7]], [[.6, .35, .05], [.05, .35, .6]], [[.7, .2, .1], [.3, .2, .5]],
                     [[.2, .7, .1], [.05, .7, .25]], [[.5, .3, .2], [.2, .3, .5]]])
    true = (rng.random(n) < share).astype(int)
    votes = np.stack([[rng.choice(3, p=says[k, y]) for y in true] for k in range(pii.LABELERS)], 1)
    counts = Counter(map(tuple, votes.tolist()))
    vote, count = np.array(list(counts)), np.array(list(counts.values()), float)
    model = pii.reliabilities(np.zeros(len(vote), int), vote, count)
    assert abs(model.share[0] - share) < 0.05 and np.abs(model.says - says).max() < 0.06
    guess = dict(zip(map(tuple, vote.tolist()), model.truth(np.zeros(len(vote), int), vote) > 0.5))
    majority = (votes - 1).sum(1) > 0
    right = np.mean([guess[tuple(v)] == bool(y) for v, y in zip(votes.tolist(), true)])
    assert right > 0.9 and right >= np.mean(majority == (true == 1))


TRUE = [("email", "write to {} soon", lambda r: f"{r.choice('abcdef')}{r.randint(1, 99)}.lee [at] mail{r.randint(1, 9)} [dot] com"),
        ("email", "contact {} now", lambda r: f"kim{r.randint(1, 99)} at example dot org"),
        ("phone", "call me at {} please", lambda r: f"({r.randint(200, 999)}) {r.randint(200, 999)}-{r.randint(1000, 9999)}"),
        ("ip", "the host {} is down", lambda r: "[.]".join(str(r.randint(11, 200)) for _ in range(4))),
        ("card", "pay with card {} today", lambda r: "3782 822463 10005")]
FALSE = [lambda r: f"pages {r.randint(100, 200)}-{r.randint(201, 300)} {r.randint(1990, 2000)}",
         lambda r: f"at {r.randint(10, 12)}:30:45 on the day", lambda r: f"order {r.randint(1000, 9999)} 5678 9011",
         lambda r: f"invoice {r.randint(10**12, 10**13 - 1)}", lambda r: "the cat sat at home", lambda r: "look at v1.2 now",
         lambda r: f"section {r.randint(1, 9)} . 2 . 900 . 4"]


def labelled(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        if r.random() < 0.5:
            kind, frame, make = r.choice(TRUE)
            value = make(r)
            text = frame.format(value)
            out.append((i, text, [(kind, text.index(value), text.index(value) + len(value))]))
        else:
            out.append((i, r.choice(FALSE)(r), []))
        if r.random() < 0.3:
            out.append((n + i, f"ask bob{i}@mail.com or +1 555 555-{r.randint(1000, 9999)} at 10.1.2.{i % 250}", None))
    return out


def test_held_out_accuracy(spark):
    rows = labelled(400, 1)
    model = pii.learn(spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"))
    scores = pii.scores(model)
    assert all(abs(scores[p] - model.score(p)) < 1e-12 for p in list(scores)[::501])
    hit = wrong = missed = 0
    for _, text, want in labelled(400, 2):
        got = [s[:3] for s in pii.chosen(text, scores, pii.THRESHOLD)]
        if want is None:
            assert got == plain_base(text)
            continue
        hit += len(set(got) & set(want))
        wrong += len(set(got) - set(want))
        missed += len(set(want) - set(got))
    assert hit / (hit + wrong) >= 0.97 and hit / (hit + missed) >= 0.95, (hit, wrong, missed)


def test_awkward_rows_and_masking(spark):
    extra = [(70, "a@b.co é 4111 1111 1111 1111, +44 20 7946 0958", "en", "a"), (70, "a@b.co", "en", "a"),
             (None, "\U0001f600 10.0.0.1\u0000 x@y.zz", None, None), (71, "x@y.zz " * 500, "en", "a")]
    frame = weird(spark, extra)
    model = pii.learn(frame)
    got = pii.find_pii(frame, model).collect()
    rows = [(i, t) for i, t, *_ in [*WEIRD, *extra]]
    base = sorted(((r.id, [(s.kind, s.start, s.end) for s in r.spans if s.base]) for r in got), key=repr)
    assert base == sorted(((i, plain_base(t)) for i, t in rows), key=repr)
    for r in got:
        places = [(pii.KINDS.index(s.kind), s.start) for s in r.spans]
        assert places == sorted(places) and len(got) == len(rows)
    masked = {(r.id, r.n_spans): r.text for r in pii.masked(frame, model).collect()}
    assert masked[70, 3] == "<email> é <card>, <phone>" and masked[70, 1] == "<email>"
    assert masked[None, 2] == "\U0001f600 <ip>\u0000 <email>"
    assert pii.find_pii(empty(spark), pii.learn(empty(spark))).collect() == []


def test_counts_cover_all_documents_and_reruns_agree(spark):
    texts = [(i, f"{t} mail a{i}@b.com and 1.2.3.{i % 300} or (555) 555-01{i % 90 + 10}") for i, t in prose(200, 4)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    want = Counter(c[4] for _, t in texts for c in pii.candidates(t))
    assert dict(map(tuple, pii.pattern_counts(df.repartition(5)).collect())) == want
    a, b = (pii.learn(df.repartition(k)) for k in (2, 7))
    assert all((a.coefficients[k] == b.coefficients[k]).all() for k in pii.KINDS)


def test_query_equals_plain_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    counts = Counter(c[4] for r in docs for c in pii.candidates(r.text or ""))
    scores = pii.scores(pii.fit(counts))
    want = []
    for r in docs:
        base, kinds = plain_base(r.text), Counter(s[0] for s in plain_base(r.text))
        spans = pii.chosen(r.text or "", scores, pii.THRESHOLD)
        text = ",".join(":".join(map(str, s)) for s in base)
        want.append((r.doc_id, *(kinds[k] for k in pii.KINDS), hashlib.sha256(text.encode()).hexdigest(),
                     ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in spans)))
    assert sorted(tuple(r) for r in QUERIES["op12_pii"](spark, SF).collect()) == sorted(want)
