"""Operators 1 and 9 against plain Python, and the sketch's guarantee."""
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import blobs, line_dedup, sketch, substring_dedup, textblocks
from . import fixtures as fx

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_lines(rows, run):
    rows = sorted(rows)
    seqs = [(i, [x for x in (t or "").split("\n") if WORD.search(x)]) for i, t in rows]
    seen, gone = set(), {i: set() for i, _ in rows}
    for i, lines in seqs:
        for k in range(len(lines) - run + 1):
            w = tuple(lines[k:k + run])
            if w in seen:
                gone[i] |= set(range(k, k + run))
            seen.add(w)
    out = {}
    for i, t in rows:
        kept, n = [], 0
        for line in (t or "").split("\n"):
            if WORD.search(line):
                if n not in gone[i]:
                    kept.append(line)
                n += 1
            else:
                kept.append(line)
        out[i] = ("\n".join(kept), n, len(gone[i]))
    return out


def brute_words(rows, width):
    seen, out = set(), {}
    for i, t in sorted(rows):
        words = WORD.findall(t or "")
        gone = set()
        for k in range(len(words) - width + 1):
            w = tuple(words[k:k + width])
            if w in seen:
                gone |= set(range(k, k + width))
            seen.add(w)
        out[i] = (" ".join(x for k, x in enumerate(words) if k not in gone), len(words), len(gone))
    return out


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    out = [(i, t) for i, t, *_ in fx.WEIRD] + [(1000 + i, t) for i, t in fx.prose(150, 4)]
    stock = [f"stock line {k} with words" for k in range(12)]
    for i in range(60):
        lines = [r.choice(stock) if r.random() < 0.7 else f"own {i} {k}" for k in range(r.randint(0, 14))]
        if r.random() < 0.3:
            k = r.randrange(len(lines) + 1)
            lines[k:k] = stock[2:2 + r.randint(2, 6)] + [" "]
        out.append((5000 + i, "\n".join(lines)))
    r.shuffle(out)
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*x, 1, "x", 0) for x in rows], "doc_id long, text string, id int, body string, key long")


@pytest.mark.parametrize("run", [1, 2, 3, 5])
def test_lines(docs, rows, run):
    got = {r.id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.line_dedup(docs, run).collect()}
    assert got == brute_lines(rows, run)


def brute_long_lines(rows, run, long_words):
    """Runs of ``run`` lines, shortest ones of ``long_words`` words, and whole short documents."""
    def long(lines):
        return sum(len(WORD.findall(x)) for x in lines) >= long_words
    seen, out = set(), {}
    for i, t in sorted(rows):
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        gone = set()
        for a in range(len(lines)):
            for b in range(a + 1, min(a + run, len(lines)) + 1):
                w = tuple(lines[a:b])
                if len(w) == run or len(w) == len(lines) or long(w) and not long(w[:-1]):
                    gone |= set(range(a, b)) if w in seen else set()
                    seen.add(w)
        out[i] = (len(lines), gone, [x for k, x in enumerate(lines) if k not in gone])
    return out


@pytest.mark.parametrize("run,long_words", [(3, 20), (3, 8), (5, 1), (2, 1000)])
def test_long_lines_and_short_documents(docs, rows, run, long_words):
    want = brute_long_lines(rows, run, long_words)
    got = {r.id: (r.n_lines, r.n_removed, [x for x in r.text.split("\n") if WORD.search(x)])
           for r in line_dedup.line_dedup(docs, run, long_words=long_words).collect()}
    assert got == {i: (n, len(gone), kept) for i, (n, gone, kept) in want.items()}
    assert all(got[i][1] >= gone for i, (_, _, gone) in brute_lines(rows, run).items())


def test_one_line_is_enough_where_it_is_long(spark):
    line, pair = " ".join(f"w{k}" for k in range(30)), "a b c d e f g h i j k\nl m n o p q r s t u"
    rows = [(1, f"x\n{line}\ny"), (2, f"u\n{line}\nv"), (3, f"x1\n{pair}"), (4, f"{pair}\ny1"), (5, "tiny"), (6, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.text for r in line_dedup.line_dedup(docs, long_words=20).collect()}
    assert got == {**dict(rows), 2: "u\nv", 4: "y1", 6: ""}


@pytest.mark.parametrize("width,max_bits", [(20, 29), (20, 10), (3, 12)])
def test_words(docs, rows, width, max_bits):
    got = {r.id: (r.text, r.n_words, r.n_removed)
           for r in substring_dedup.substring_dedup(docs, width, max_bits).collect()}
    assert got == brute_words(rows, width)


def test_small_flushes_give_the_same(spark, rows, monkeypatch):
    """What meets inside a task and what meets in a bucket make no difference."""
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.id: (r.text, r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(docs, 5).collect()}
    assert got == brute_words(rows, 5)
    lines = {r.id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.line_dedup(docs, 2).collect()}
    assert lines == brute_lines(rows, 2)


def test_repeated_rows_null_ids_and_empty(spark):
    text = "\n".join(f"line {k} has a few words in it today" for k in range(6))
    rows = [(1, text), (1, text), (None, text), (2, text), (3, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = line_dedup.line_dedup(docs).collect()
    words = substring_dedup.substring_dedup(docs).collect()
    assert sorted((r.id is None, r.id or 0, r.n_removed) for r in lines) == [
        (False, 1, 6), (False, 1, 6), (False, 2, 6), (False, 3, 0), (True, 0, 0), (True, 0, 0)]
    assert sorted((r.id is None, r.id or 0, r.n_removed) for r in words) == [
        (False, 1, 54), (False, 1, 54), (False, 2, 54), (False, 3, 0), (True, 0, 0), (True, 0, 0)]
    assert line_dedup.line_dedup(fx.empty(spark)).count() == 0
    assert substring_dedup.substring_dedup(fx.empty(spark)).count() == 0


def test_fingerprints_are_guaranteed():
    """Equal runs select the same line, wherever they stand."""
    r = random.Random(0)
    lines = [f"l{r.randrange(6)}".encode() for _ in range(400)]
    for run in (2, 3, 4):
        by_run = {}
        for f, _, place, a, b in line_dedup.document_windows(b"\n".join(lines), run):
            by_run.setdefault((a, b), set()).add(f)
            assert len(by_run[a, b]) == 1
        assert len(by_run) == len({tuple(lines[k:k + run]) for k in range(len(lines) - run + 1)})


@pytest.mark.parametrize("bits", [10, 16, 23])
def test_sketch_never_underestimates(spark, bits):
    rng = np.random.default_rng(bits)
    keys = rng.integers(0, 2**63, 3000).astype(np.uint64)
    some = np.concatenate([keys, keys[:500], keys[:100]])
    rng.shuffle(some)
    rows = spark.createDataFrame([(int(k),) for k in some], "k long").repartition(5)
    got = sketch.build(rows, lambda batch: iter([batch.column(0).to_numpy().view(np.uint64)]), bits)
    assert got.repeated(keys[:500]).all()
    if bits == 23:
        assert got.repeated(keys[500:]).mean() < 0.01


def test_gaps_round_trip():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (1000, 300), (1000, 1 << 22)):
        v = np.sort(rng.integers(0, top, n))
        assert sketch.ungaps(sketch.gaps(v)).tolist() == v.tolist()
    assert [x.tolist() for x in blobs.unpack(blobs.pack(np.arange(3), np.zeros(0, np.uint16)))] == [[0, 1, 2], []]


def test_hashes_tell_words_apart():
    import pyarrow as pa
    texts = ["a b", "ab", "b a", "", "a\tb\n", "é", " a  b ", "x" * 50]
    for size in (1, 1 << 20):
        out = []
        for block in textblocks.blocks(pa.array(texts), size):
            s, e, d = block.words()
            h = textblocks.word_hashes(block.data, s, e)
            off = textblocks.bounds(d, block.n)
            out += [tuple(h[off[i]:off[i + 1]].tolist()) for i in range(block.n)]
        assert out[0] == out[4] == out[6] and out[2] == out[0][::-1] and out[3] == ()
        assert len({out[0], out[1], out[2], out[5], out[7]}) == 5
