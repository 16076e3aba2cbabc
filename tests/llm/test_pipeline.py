"""Operators 3 and 8 on small tables, and the pipeline against its brute-force version."""
import hashlib
import math
from collections import Counter

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from panelcast.llm import exact_dedup as E
from panelcast.llm import mixing as M
from panelcast.llm import quality
from . import fixtures as fx
from .test_jaccard import brute as brute_components
from .test_tokens_ops import WORD, check_packing, tokenizer  # noqa: F401


# --- exact dedup ------------------------------------------------------------

def brute_classes(rows, pick):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        g = groups[t or ""]
        ids = [x for x in g if x is not None]
        out.append((i, pick(ids) if ids else None, len(g), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_classes(spark, keep, weak):
    """A hash of one byte collides all the time: bytes decide, not the hash."""
    rows = [(i, t) for i, t, *_ in fx.WEIRD] + fx.prose(80, 2, words=(1, 3), vocabulary=5)[1:] + [
        (None, "one"), (None, "only null"), (None, None), (3, "one"), (7000, "one")]
    docs = spark.createDataFrame([(*x, "k", 1) for x in rows], "doc_id long, text string, keep_id string, hash int")
    hash_of = (lambda c: F.substring(F.unhex(F.md5(c.cast("binary"))), 1, 1) if weak else E.content_hash(c))
    got = E.exact_classes(docs, keep=keep, hash_of=hash_of).select("id", "keep_id", "group_size", "text_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute_classes(rows, min if keep == "smallest" else max)
    assert E.exact_classes(fx.empty(spark)).count() == 0


def test_exact_dedup_keeps_columns(spark):
    docs = fx.weird(spark, [(50, "one", "en", "q"), (51, "solo", "en", "q")])
    out = E.exact_dedup(docs)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {i for i, *_ in fx.WEIRD} - {4, 1} | {51}


# --- mixing -----------------------------------------------------------------

def brute_targets(sizes, weights, share=1.5, most=2):
    total = share * sum(sizes.values())
    capped, target = set(), {}
    while True:
        free = [s for s in sizes if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        target = {s: most * sizes[s] if s in capped else left * weights[s] / sum(weights[x] for x in free) for s in sizes}
        over = {s for s in free if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target
        capped |= over


def mixing_rows(seed=0):
    rows = fx.prose(300, seed, words=(1, 80))
    names = ["big"] * 5 + ["a", "b", "ünï", None, "", "z"]
    return [(i, t, names[(i * 7) % len(names)]) for i, t in rows] + [(9000, None, "nothing"), (9001, " ", "nothing")]


def place(i):
    return int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16)


def test_mix(spark):
    rows = mixing_rows()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, size int, target string")
    got = M.mix(docs).collect()
    assert len(got) == len(rows)
    size = {i: len(WORD.findall(t or "")) for i, t, _ in rows}
    by = {}
    for i, _, s in rows:
        by.setdefault(s, []).append(i)
    sizes = {s: sum(size[i] for i in ids) for s, ids in by.items()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = brute_targets(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)})
    taken = Counter()
    for r in got:
        assert r.size == size[r.id] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.size * r.copies
    for s, ids in by.items():
        assert abs(taken[s] - want[s]) <= max(size[i] for i in ids) / 2 + 1e-6
        # Nested: by place on the hash line, copies never rise.
        copies = [r.copies for r in sorted((r for r in got if r.source == s and r.size), key=lambda r: place(r.id))]
        assert copies == sorted(copies, reverse=True)
    again = M.mix(docs.repartition(5)).collect()
    assert {(r.id, r.copies) for r in again} == {(r.id, r.copies) for r in got}
    out = M.mixed(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({r.id: r.copies for r in got if r.copies})


def test_mix_edges(spark):
    assert M.mix(fx.empty(spark)).count() == 0
    nothing = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r.target, r.copies) for r in M.mix(nothing).collect()] == [(0.0, 0)] * 2
    same = spark.createDataFrame([(7, "a b c", "s")] * 4 + [(None, "x y", "s"), (None, "z", "s")], "doc_id long, text string, source string")
    rows = M.mix(same).collect()
    assert len(rows) == 6 and len({r.copies for r in rows if r.id == 7}) == 1
    weights = spark.createDataFrame([("a", 1)], "source string, weight int")
    some = spark.createDataFrame([(1, "x " * 10, "a"), (2, "y " * 10, "b")], "doc_id long, text string, source string")
    assert {r.id: (r.target, r.copies, r.source_size) for r in M.mix(some, weights=weights, share=(1, 1)).collect()} == {
        1: (10.0, 1, 10), 2: (0.0, 0, 10)}


# --- pipeline ---------------------------------------------------------------

def test_pipeline(spark, scratch):
    rows = [(i, t) for i, t in fx.prose(160, 6, words=(30, 160))] + [(500 + k, "junk ### $$$ %%% " * 30) for k in range(3)]
    rows += [(700, None), (701, "short"), (702, "The The " * 100)]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{scratch}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "exact_dedup", "ngram_jaccard_join", "mixing", "best_fit_packing"]

    kept = {r.id for r in quality.quality(docs, P.path("piece_bpe_32k.model")).filter("kept").collect()}
    assert not kept & {500, 501, 502, 700, 701, 702}
    alive = [(i, t) for i, t in rows if i in kept]
    last = {}
    for i, t in alive:
        last[t] = max(last.get(t, i), i)
    alive = [(i, t) for i, t in alive if last[t] == i]
    comps = brute_components(alive, 75)
    alive = [(i, t) for i, t in alive if comps[i][1] == i]

    now, columns = spark.read.parquet(f"{scratch}/documents.parquet"), docs.columns
    steps = []
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, now, scratch).write.parquet(f"{scratch}/{k}")
        now = spark.read.parquet(f"{scratch}/{k}")
        steps.append(now)
        assert k == 4 or now.columns == columns
    assert {r.doc_id for r in steps[0].collect()} == kept
    assert {r.doc_id for r in steps[2].collect()} == {i for i, _ in alive}
    size = {i: len(WORD.findall(t)) for i, t in alive}
    sizes = Counter()
    for i in size:
        sizes[f"s{i % 3}"] += size[i]
    want = brute_targets(sizes, {"s0": 3, "s1": 1, "s2": 2})
    taken, copies = Counter(), Counter()
    for r in steps[3].collect():
        taken[r.source] += size[r.doc_id]
        copies[r.doc_id] += 1
    assert all(abs(taken[s] - want[s]) <= max(size.values()) / 2 for s in sizes) and max(copies.values()) <= 2
    plan = cp.run(spark, scratch).withColumnRenamed("doc_id", "id").collect()
    assert Counter((r.id, r.piece) for r in plan) == Counter((r.doc_id, r.piece) for r in now.collect())
    one = {}
    for r in plan:
        one.setdefault((r.id, r.piece), r)
    assert Counter(i for i, p in one if p == 0) == Counter(set(copies))
    assert sum(r.length for r in plan) == sum(
        n * (len(tokenizer(P.path("word_bpe_49k.json")).encode(dict(alive)[i], add_special_tokens=False).ids) + 1)
        for i, n in copies.items())
    bins = {}
    for r in plan:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= math.ceil(sum(r.length for r in plan) / 4096) + 1
