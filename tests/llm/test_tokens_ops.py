"""Operators 4, 5 and 6 against direct use of the tokenizers and plain Python."""
import math
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from panelcast.llm import packing, quality, records, textblocks, tokens
from . import fixtures as fx

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTES, CLIP, SP = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def rows():
    return [(i, t) for i, t, *_ in fx.WEIRD] + [(100 + i, t) for i, t in fx.prose(120, 3)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return fx.weird(spark, [(i, t, "en", "p") for i, t in rows[len(fx.WEIRD):]])


@lru_cache
def tokenizer(path):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def direct(path, text):
    return tokenizer(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, CLIP])
def test_pieces_equal_whole_texts(path, rows):
    import pyarrow as pa
    rng = np.random.default_rng(0)
    noise = ["".join(rng.choice(list(" \n\tab,.!é'́İ  中1:S×"), 50)) for _ in range(500)]
    texts = [t or "" for _, t in rows] + noise
    from tokenizers import Tokenizer
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    got = []
    for block in textblocks.blocks(pa.array(texts), 3000):
        ids, off = tokens.encode_block(block, tokens.huggingface(path))
        got += [ids[off[i]:off[i + 1]].tolist() for i in range(block.n)]
    assert got == want


def brute_quality(text):
    words = WORD.findall(text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(hit), len(words) < 50 or 100 * len(hit) > 50 * len(words))


def test_quality_counts(docs, rows):
    got = {r.id: r for r in quality.quality(docs, SP).collect()}
    assert len(got) == len(rows)
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=SP)
    for i, text in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(text)
        ids = [x for w in WORD.findall(text or "") for x in sp.encode(w)]
        assert r.n_tokens == len(ids)
        assert not (r.base_failed and r.kept)
        if ids:
            n, c = len(ids), Counter(ids)
            bits = -sum(v / n * math.log2(v / n) for v in c.values())
            assert r.token_entropy == pytest.approx(bits, abs=1e-9)
            assert r.byte_share == pytest.approx(sum(map(sp.is_byte, ids)) / n)


def test_quality_rejects_noise_and_keeps_scripts(spark):
    import random
    r = random.Random(1)
    english = "The committee met on Tuesday to discuss the plans for a new library in the old town hall. " * 1
    vocab = english.split() + "people often think that winter brings snow but here it mostly rains until spring arrives".split()
    good = " ".join(r.choice(vocab) for _ in range(200))
    russian = " ".join(r.choice("дом река город человек время большой утро вечер работа школа книга дорога".split()) + r.choice(["", "а", "у"]) for _ in range(120))
    noise = " ".join("".join(chr(r.randint(0x2500, 0x25FF)) for _ in range(6)) for _ in range(120))
    keys = " ".join("".join(r.choice("qxzjkvw0123456789#@~^") for _ in range(12)) for _ in range(120))
    rows = spark.createDataFrame([(1, good), (2, russian), (3, noise), (4, keys)], "doc_id long, text string")
    kept = {x.id for x in quality.quality(rows, SP).filter("kept").collect()}
    assert kept == {1, 2}


def test_records_round_trip(spark, docs, rows, scratch):
    out = records.token_records(docs, BYTES, 2, path=f"{scratch}/r")
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out.collect())
    want, start = [], 0
    for i, text in sorted(rows, key=lambda x: x[0]):
        ids = [*direct(BYTES, text), 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    some = out.filter("doc_id % 3 = 0").select("file", "offset", "doc_id")
    back = {r.doc_id: r.ids for r in records.read_at(spark, some).collect()}
    texts = dict(rows)
    assert back == {i: [*direct(BYTES, texts[i]), 2] for i in texts if i % 3 == 0}


def test_record_files_follow_bytes_and_split_a_hot_id(spark, scratch, monkeypatch):
    """Null ids first, rows repeated under one id, and a third of all rows under another."""
    monkeypatch.setattr(records, "FILE_BYTES", 4000)
    monkeypatch.setattr(records, "FILES_BY_NAME", 3)
    data = [(None, "null one"), (None, None), (3, "three"), (3, "three"), (3, "other three")]
    data += [(7, f"hot row {k % 40} " * 12) for k in range(120)] + [(100 + k, f"cold row {k} " * 9) for k in range(200)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    index = records.token_records(docs, BYTES, 2, path=f"{scratch}/hot")
    got = sorted(index.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in data), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    want = sorted((str(i), len(direct(BYTES, t or "")) + 1) for i, t in data)
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == want
    sizes = {}
    for r in got:
        sizes[r.file] = sizes.get(r.file, 0) + r.length
    assert len({r.file for r in got if r.doc_id == 7}) > 1 and max(sizes.values()) < 40_000
    again = records.open_index(spark, f"{scratch}/hot")
    assert sorted(again.collect()) == sorted(got)
    for some in (again.filter("doc_id = 7"), again.filter("doc_id = 3"), again.limit(0), again):
        back = sorted((str(r.doc_id), r.ids) for r in records.read_at(spark, some.select("file", "offset")).collect())
        ids = sorted(str(r.doc_id) for r in some.collect())
        assert [i for i, _ in back] == ids and all(x[-1] == 2 for _, x in back)
    three = records.read_at(spark, again.filter("doc_id = 3").select("file", "offset")).collect()
    assert sorted(r.ids for r in three) == sorted([*direct(BYTES, t), 2] for i, t in data if i == 3)


def test_records_of_wide_ids(spark, scratch):
    """Ids above 65,535 come back whole, or raise where the width is given."""
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers
    tok = Tokenizer(models.WordLevel({f"w{k}": k for k in range(70_000)}, unk_token="w0"))
    tok.normalizer, tok.pre_tokenizer = normalizers.Lowercase(), pre_tokenizers.WhitespaceSplit()
    tok.save(f"{scratch}/wide.json")
    docs = spark.createDataFrame([(1, "w69999 w3 w65536"), (2, "w65535")], "doc_id long, text string")
    for vocabulary, end in ((f"{scratch}/wide.json", 1), (BYTES, 70_000)):
        index = records.token_records(docs, vocabulary, end, path=f"{scratch}/wide{end}")
        back = {r.doc_id: r.ids for r in records.read_at(spark, index.select("file", "offset")).collect()}
        want = ({1: [69999, 3, 65536, 1], 2: [65535, 1]} if end == 1 else
                {1: [*direct(BYTES, "w69999 w3 w65536"), end], 2: [*direct(BYTES, "w65535"), end]})
        assert back == want
    with pytest.raises(ValueError):
        records.frame(1, np.array([65_536]), 2)


def test_records_damage_is_noticed():
    data = bytearray(records.frame(7, np.arange(9), 2) + b"\n" + records.frame(None, np.arange(70000, 70003), 4) + b"\n")
    doc, ids, at = records.unframe(memoryview(data))
    assert (doc, ids.tolist()) == (7, list(range(9)))
    assert records.unframe(memoryview(data), at)[0] is None
    assert records.unframe(memoryview(data), at)[1].tolist() == [70000, 70001, 70002]
    for k in range(at - 1):
        bad = bytearray(data)
        bad[k] ^= 1
        with pytest.raises(ValueError):
            records.unframe(memoryview(bad))


def check_packing(rows, plan, capacity):
    pieces = {}
    for i, text in rows:
        ids = [*direct(CLIP, text), 1]
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s:s + capacity]
            pieces[i, k] = (s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert {(r.id, r.piece): (r.start, r.length, r.ids_crc32) for r in plan} == pieces
    assert len(plan) == len(pieces)
    bins = {}
    for r in plan:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(v[1] for v in pieces.values())


def test_packing(docs, rows):
    for capacity in (4096, 200):
        plan = packing.pack_documents(docs, CLIP, 1, capacity).collect()
        n, total = check_packing(rows, plan, capacity)
        assert n <= math.ceil(total / capacity) * 1.12 + 1


def test_sequences_hold_the_ids(spark):
    rows = fx.prose(30, 9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = packing.token_pieces(docs, CLIP, 1, 256)
    plan = packing.pack(pieces.select("id", "piece", "length"), 256)
    out = packing.sequences(pieces, plan).collect()
    assert sum(len(r.ids) for r in out) == 4 * sum(len(direct(CLIP, t)) + 1 for _, t in rows)
    assert all(len(r.ids) == 4 * sum(r.lengths) <= 1024 for r in out)


def test_best_fit_closes_the_fullest_first():
    b = packing.BestFit(100, open_bins=2)
    assert [b.place(n) for n in (60, 70, 90)] == [(0, 0), (1, 0), (2, 0)]  # closes bin 1 (30 free)
    assert b.place(40) == (0, 60) and b.place(10) == (2, 90) and b.place(1) == (3, 0)


def test_empty_tables(spark):
    none = fx.empty(spark)
    assert quality.quality(none, SP).count() == 0
    assert records.token_records(none, BYTES, 2).count() == 0
    assert packing.pack_documents(none, CLIP, 1).count() == 0


def plain_verdict(text, sp):
    """Operator 4's verdict from the whole text, bands included."""
    n_words, chars, symbols, _, _, failed = brute_quality(text)
    ids = [x for w in WORD.findall(text or "") for x in sp.encode(w)]
    if failed or not ids:
        return False
    seen = Counter()
    for b in (text or "").encode():
        if quality._LEAD[b] >= 0:
            seen[quality.SCRIPTS[quality._LEAD[b]]] += 1
    script = min(seen, key=lambda s: (-seen[s], quality.SCRIPTS.index(s))) if seen else "other"
    band, n, c = quality.BANDS[script], len(ids), Counter(ids)
    bits = -sum(v / n * math.log2(v / n) for v in c.values())
    share = sum(sp.is_byte(i) or sp.is_unknown(i) for i in ids) / n
    return (band.chars_per_token[0] <= chars / n <= band.chars_per_token[1] and share <= band.byte_share
            and band.entropy[0] <= bits <= band.entropy[1] and symbols <= band.symbols_per_token * n)


def test_quality_verdict_by_brute_force(spark):
    """Every band recomputed: on the given documents, on noise, and on rows repeated under one id."""
    import base64
    import random

    import sentencepiece
    sp, r = sentencepiece.SentencePieceProcessor(model_file=SP), random.Random(3)
    made = ["".join(r.choice("abcdefghij klmnop") for _ in range(900)), " ".join("%032x" % r.getrandbits(128) for _ in range(60)),
            " ".join(base64.b64encode(r.randbytes(30)).decode() for _ in range(60)), " ".join(["élève déjà".encode().decode("latin1")] * 60),
            " ".join(str(r.randrange(10**9)) for _ in range(90)), "# $ word " * 60, "слово дело " * 60, "文字列です " * 70,
            " ".join("".join(chr(r.randint(0x2500, 0x25FF)) for _ in range(6)) for _ in range(120)), "a b " * 100]
    rows = [(x.doc_id, x.text) for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(10_000 + k, t) for k, t in enumerate(made)] + [(10_000, made[0]), (10_000, made[0]), (None, made[5])]
    got = quality.quality(spark.createDataFrame(rows, "doc_id long, text string"), SP).select("id", "kept").collect()
    want = sorted(((i, plain_verdict(t, sp)) for i, t in rows), key=repr)
    assert sorted(map(tuple, got), key=repr) == want
    assert {k for _, k in want} == {True, False} and len({i for i, k in want if not k and (i or 0) >= 10_000}) >= 6


def test_packing_of_null_ids_and_repeated_rows(spark):
    rows = [(None, "null id"), (None, "another null id"), (4, "four four"), (4, "four four"), (4, "other"), (5, None)]
    rows += [(9, "long text " * 300)] * 2
    docs = spark.createDataFrame([(*x, "x", 1) for x in rows], "doc_id long, text string, piece string, id int")
    plan = packing.pack_documents(docs, CLIP, 1, 64).collect()
    want = []
    for i, text in rows:
        ids = [*direct(CLIP, text or ""), 1]
        want += [(i, k, s, zlib.crc32(np.array(ids[s:s + 64], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 64))]
    assert sorted(((r.id, r.piece, r.start, r.ids_crc32) for r in plan), key=repr) == sorted(want, key=repr)
    bins = {}
    for r in plan:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
