"""Token ids of whole texts, computed once per distinct piece of text.

A text is cut where every tokenizer used here is known to start a new
pre-token: around a single space or line feed between two safe characters, and
between a letter and closing punctuation. Distinct pieces go through the real
tokenizer; their ids are remembered for the life of the Python worker (a bounded
table) and laid out again per document. The ids equal those of encoding the
whole text (``tests/llm/test_tokens.py`` compares them).
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .textblocks import Block, flat

#: Remembered pieces per tokenizer and worker; beyond it the table starts anew.
REMEMBER = 1_000_000
#: A piece of letters only (ASCII and the letters of the first two-byte page) is a
#: single pre-token for both tokenizers and can go straight to their BPE model.
_PLAIN = re.compile(rb"[ \n]?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch


class PieceIds:
    """Ids by piece: a dictionary from bytes to a number, and flat arrays. ``top`` is
    the largest id of the vocabulary."""

    def __init__(self, encode, top: int):
        self.encode, self.top = encode, top
        self._reset()

    def _reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.offsets, self.used = np.zeros(1 << 16, np.uint32), np.zeros(1 << 12, np.int64), 0

    def numbers(self, pieces: list[bytes]) -> np.ndarray:
        """Numbers of the pieces in this table, after encoding the new ones."""
        if len(self.known) > REMEMBER:
            self._reset()
        known = self.known
        new = [p for p in pieces if p not in known]
        if new:
            got = self.encode(new)
            lengths = np.fromiter(map(len, got), np.int64, len(got))
            total, n = int(lengths.sum()), len(known)
            while self.used + total > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            while n + len(new) + 1 > len(self.offsets):
                self.offsets = np.concatenate([self.offsets, np.zeros_like(self.offsets)])
            self.ids[self.used:self.used + total] = np.fromiter((x for g in got for x in g), np.uint32, total)
            self.offsets[n + 1:n + 1 + len(new)] = self.used + np.cumsum(lengths)
            self.used += total
            known.update(zip(new, range(n, n + len(new))))
        return np.fromiter((known[p] for p in pieces), np.int64, len(pieces))


def _byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level BPE."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def huggingface(path: str) -> PieceIds:
    """Pieces by the ``tokenizers`` library, without special tokens added.

    Pieces of plain letters skip the normaliser and pre-tokenizer, which would
    return them as they are (lower-cased and without the blank where the
    vocabulary is one of lower-case words), and go to the tokenizer's model."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tokenize, characters, lowers = tok.model.tokenize, _byte_characters(), tok.normalizer is not None

    def plain(piece: bytes) -> list[int]:
        if lowers:
            piece = piece.strip().decode().lower().encode()
        return [t.id for t in tokenize(piece.decode("latin-1").translate(characters))]

    def encode(pieces: list[bytes]) -> list[list[int]]:
        out = [plain(p) if _PLAIN(p) and (lowers or p[:1] != b"\n") else None for p in pieces]
        rest = [i for i, x in enumerate(out) if x is None]
        if rest:
            texts = [pieces[i].decode("utf-8", "replace") for i in rest]
            for i, e in zip(rest, tok.encode_batch(texts, add_special_tokens=False)):
                out[i] = e.ids
        return out

    return PieceIds(encode, max(tok.get_vocab().values(), default=0))


@lru_cache(maxsize=4)
def sentencepiece(path: str) -> PieceIds:
    import sentencepiece as sp

    model = sp.SentencePieceProcessor(model_file=path)
    return PieceIds(lambda pieces: model.encode([p.decode("utf-8", "replace") for p in pieces], num_threads=1),
                    model.vocab_size() - 1)


@lru_cache(maxsize=4)
def byte_tokens(path: str) -> np.ndarray:
    """Which ids of a sentencepiece model are single-byte fallbacks."""
    import sentencepiece as sp

    model = sp.SentencePieceProcessor(model_file=path)
    return np.array([model.is_byte(i) or model.is_unknown(i) for i in range(model.vocab_size())])


_ASCII = np.zeros(256, bool)
_ASCII[0x21:0x7F] = True
_TWO_BYTE_LEAD = np.zeros(256, bool)
_TWO_BYTE_LEAD[0xC3:0xE0] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_CLOSING = np.zeros(256, bool)
_CLOSING[[ord(c) for c in ".,;:!?)"]] = True


def cuts(block: Block) -> np.ndarray:
    """Byte offsets of the pieces of a block (documents' bounds included)."""
    d = block.data
    n = len(d)
    mark = np.zeros(n + 1, bool)
    if n > 2:
        blank = (d == 0x20) | (d == 0x0A)
        # The character before position i ends in a safe way: ASCII, or the last byte of a
        # two-byte letter (white space of Unicode has other lead bytes).
        safe_end = _ASCII[d]
        safe_end[1:] |= _TWO_BYTE_LEAD[d[:-1]]
        safe_start = _ASCII[d] | _TWO_BYTE_LEAD[d]
        alone = np.zeros(n, bool)
        alone[1:-1] = blank[1:-1] & safe_end[:-2] & safe_start[2:]
        mark[:-1] |= alone
        mark[1:] |= alone & (d == 0x0A)
        mark[1:-1] |= _LETTER[d[:-1]] & _CLOSING[d[1:]]
    mark[block.offsets] = True
    return np.flatnonzero(mark)


def encode_block(block: Block, table: PieceIds) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents of a block, one after another, and offsets by document."""
    at = cuts(block)
    if len(at) < 2:
        return np.zeros(0, np.uint32), np.zeros(block.n + 1, np.int64)
    pieces = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(block.data))])
    coded = pieces.dictionary_encode()
    which = table.numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
    ids, lengths = flat(table.ids, table.offsets, which)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return ids, ends[np.searchsorted(at, block.offsets)]
