"""Operator 12: personal data by weak supervision.

Base spans are what the strict patterns match; they always stand. Around them the
method adds spans in looser spellings (obfuscated mail addresses, bracketed or
version-6 network addresses, other card lengths and separators, national phone
numbers):

1. Wide patterns give candidates, the base spans among them. Five labelers vote
   +1, 0 or -1 on each: the strict pattern on the normalised span, its structure
   (Luhn, octets, digit counts), a gazetteer (endings, number ranges, calling codes),
   the words around it, and its edges.
2. Candidates are counted by kind, votes and shape over all documents; what reaches
   the driver is at most one row per possible pattern, whatever the corpus.
   Expectation-maximisation on the counts estimates, per kind, how often a labeler
   says what on true and on false spans, and so how likely each pattern is true.
3. A logistic span classifier per kind (votes and shape) is trained on all patterns
   with those likelihoods as soft labels and their counts as weights. Its score for
   each pattern goes to the tasks as a table, and a second pass over the texts adds
   the candidates that reach ``threshold`` and overlap no base span or better one.

Scanning is linear in the text: no pattern backs up over a run it has read more than a
bounded number of characters. Counts are sums of integers and the fits run in a fixed
order, so reruns agree. Positions are code points, ends exclusive.

Edge cases: a null text is empty and has no span; a null id, rows repeated under one id
(each a row of its own, each counted) and extra columns are no matter; an empty
table gives an empty result, and a model of nothing but its priors.
"""

from __future__ import annotations

import bisect
import ipaddress
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow, ship_package

KINDS = ("email", "ip", "card", "phone")
THRESHOLD = 0.9

# --- base spans ------------------------------------------------------------------

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, and a run is never given back.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    twice = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    own = [int(d) for d in reversed(digits)]
    return (sum(own[::2]) + sum(twice[d] for d in own[1::2])) % 10 == 0


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the run of local characters before each @, from the last match on."""
    done, at = 0, text.find("@")
    seen = 0
    while at >= 0:
        run = text[max(done, seen):at]
        start = max(done, seen) + len(run.rstrip(LOCAL))
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        seen = at + 1  # no local part holds an @
        at = text.find("@", max(done, seen))


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the strict patterns, kinds as listed, then by place."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    out += [("ip", *m.span()) for m in _IP.finditer(text) if _octets(m.group())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := digits_of(m.group())) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return out


# --- candidates ------------------------------------------------------------------

_SIGN = r" ?[\[({<] ?(?:at|AT|@) ?[\])}>] ?"
_DOT = r"(?:\.| ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?| (?:dot|DOT) )"
_AT = re.compile(rf"{_SIGN}| ?@ ?| (?:at|AT) ")
_WIDE_DOMAIN = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,8}}")
_BEFORE = re.compile(r"[A-Za-z0-9._%+-]{1,64}$")
_WIDE_IP = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:(?: ?\. ?|{_DOT})[0-9]{{1,3}}){{3}}(?![0-9])")
_IP6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}){1,6}(?![0-9A-Za-z:])")
_WIDE_CARD = re.compile(r"(?<![0-9])(?:[0-9]{13,15}|[0-9]{4}(?:[ ._/–-]{1,3}[0-9]{4}){3}"
                        r"|3[47][0-9]{2}[ ._/–-]{1,3}[0-9]{6}[ ._/–-]{1,3}[0-9]{5})(?![0-9])")
_WIDE_PHONE = re.compile(r"(?<![0-9A-Za-z+.])(?:00[1-9][0-9]{0,2}[ ./-]{1,2})?(?:\([0-9]{2,5}\)[ ./-]{0,2}|[0-9]{2,5}[ ./-]{1,2})"
                         r"[0-9]{3,4}[ ./-]{1,2}[0-9]{3,5}(?![0-9A-Za-z])")


def wide_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans of the loose patterns; they may overlap each other and the base spans."""
    lower = text.lower()
    if "@" in text or "at]" in lower or "at)" in lower or "at}" in lower or "at>" in lower or " dot " in lower:
        for m in _AT.finditer(text):
            head = _BEFORE.search(text[max(0, m.start() - 64):m.start()])
            tail = _WIDE_DOMAIN.match(text, m.end())
            if head and tail and (m.group().strip().lower() != "at" or " dot " in tail.group().lower()):
                yield "email", m.start() - len(head.group()), tail.end()
    for m in _WIDE_IP.finditer(text):
        yield "ip", *m.span()
    if ":" in text:
        for m in _IP6.finditer(text):
            yield "ip", *m.span()
    for m in _WIDE_CARD.finditer(text):
        yield "card", *m.span()
    for m in _WIDE_PHONE.finditer(text):
        yield "phone", *m.span()


_NATIONAL = re.compile(r"[2-9][0-9]{2}([ .-])[2-9][0-9]{2}\1[0-9]{4}")
_ANY = re.compile(r"[0-9@]|[Dd][Oo][Tt]|[Aa][Tt][\])}>]| :|::")


# --- labelers --------------------------------------------------------------------

# Endings of mail domains, calling codes, card number ranges, context words.
ENDINGS = {"com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "dev", "app", "ai", "eu", "uk", "us",
           "de", "fr", "es", "it", "nl", "be", "ch", "at", "pl", "pt", "se", "no", "fi", "dk", "cz", "ru", "ua", "tr",
           "cn", "jp", "kr", "in", "br", "mx", "ar", "cl", "co", "ca", "au", "nz", "za", "ie", "gr", "il", "sg"}
CALLING = {"1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48",
           "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86",
           "90", "91", "92", "351", "352", "353", "358", "380", "420", "852", "886", "966", "971", "972"}
FOR = {"email": r"e-?mails?|mail|contact|write|reach|address|correo|courriel|kontakt",
       "ip": r"ip|ipv[46]|host|server|client|gateway|address|login|from|adresse",
       "card": r"cards?|visa|mastercard|amex|credit|debit|pay|payment|karte|carte|tarjeta",
       "phone": r"phone|call|tel|telephone|mobile|cell|fax|dial|whatsapp|sms|telefon|t[ée]l[ée]phone|tel[ée]fono"}
AGAINST = {"email": r"version|git|ssh|regex|pattern|decorator",
           "ip": r"version|v|ver|release|section|chapter|sec|clause|oid|build|revision|paragraph",
           "card": r"isbn|ean|order|invoice|serial|tracking|hash|timestamp|id|sku|checksum|page|part",
           "phone": r"isbn|issn|order|invoice|serial|page|pages|pp|vol|version|total|sum|dated?|year|score|sku|part|doi"}
_FOR = {k: re.compile(rf"(?<![^\W_])(?:{v})(?![^\W_])", re.I) for k, v in FOR.items()}
_AGAINST = {k: re.compile(rf"(?<![^\W_])(?:{v})(?![^\W_])", re.I) for k, v in AGAINST.items()}
NEAR = 32
LABELERS = 5


def normal(kind: str, span: str) -> str:
    """The span as the strict pattern would have it written."""
    if kind in ("card", "phone"):
        return digits_of(span)
    span = re.sub(_DOT, ".", span)
    span = re.sub(_SIGN, "@", span)
    if kind == "email":
        span = re.sub(r" ?@ ?| (?:at|AT) ", "@", span, count=1)
    return span.replace(" ", "")


def _ip_of(text: str):
    try:
        return ipaddress.ip_address(text)
    except ValueError:
        return None


def votes(kind: str, text: str, a: int, b: int) -> tuple[int, ...]:
    """One vote of -1, 0 or 1 from each labeler on the span [a, b) of ``text``."""
    span = text[a:b]
    plain = normal(kind, span)
    if kind == "email":
        local, _, domain = plain.partition("@")
        labels = domain.split(".")
        strict = 1 if plain == span and _DOMAIN.fullmatch(domain) else 0
        structure = 1 if local and not local.startswith((".", "-")) and all(
            x and x[0] != "-" and x[-1] != "-" for x in labels) and labels[-1].isalpha() else -1
        known = 1 if labels[-1].lower() in ENDINGS else -1
    elif kind == "ip":
        ip = _ip_of(plain)
        strict = 1 if ip is not None and plain == span else (0 if ip is not None else -1)
        structure = 1 if ip is not None else -1
        known = 0 if ip is None else (-1 if ip.is_unspecified or ip.is_loopback or ip.is_multicast
                                      or (ip.version == 4 and int(ip) >> 24 < 4) else 1)
    elif kind == "card":
        n = len(plain)
        strict = 1 if 16 <= n <= 19 and luhn(plain) else 0 if luhn(plain) else -1
        structure = 1 if luhn(plain) and len(set(plain)) > 2 else -1
        two, four = int(plain[:2]), int(plain[:4])
        known = 1 if (plain[0] == "4" and n in (13, 16, 19)) or ((51 <= two <= 55 or 2221 <= four <= 2720) and n == 16) or (
            two in (34, 37) and n == 15) or ((four == 6011 or two in (35, 65)) and n == 16) else -1
    else:
        n = len(plain)
        strict = 1 if span.startswith("+") and 8 <= n <= 15 else 0
        usual = span.startswith(("+", "00", "(", "0")) or _NATIONAL.fullmatch(span)
        structure = -1 if not 9 <= n <= 15 or len(set(plain)) <= 2 else 1 if usual else 0
        code = plain if span.startswith("+") else plain[2:] if plain.startswith("00") else ""
        known = (1 if any(code[:k] in CALLING for k in (1, 2, 3)) else -1) if code else (1 if span.startswith("(") else 0)
    around = text[max(0, a - NEAR):a] + " " + text[b:b + NEAR // 2]
    context = bool(_FOR[kind].search(around)) - bool(_AGAINST[kind].search(around))
    before, after = text[a - 1:a], text[b:b + 1]
    glued = before.isalnum() or after.isalnum() or before in ("_", "=", "#", "/") or after in ("_", "=", "#", "/")
    return strict, structure, known, context, -1 if before and glued or after and glued else 1


SHAPES = 3 * 4


def shape(kind: str, span: str) -> int:
    """How the span is written: its separators, and its length in digits or labels."""
    marks = 2 if re.search(r"[\[({<]|dot|DOT", span) else 1 if " " in span or "-" in span else 0
    n = len(digits_of(span)) if kind in ("card", "phone") else span.count(".") + span.count(":")
    return marks * 4 + min(3, max(0, (n - 7) // 3 if kind in ("card", "phone") else n - 1))


def code(kind: str, base: bool, vote: tuple[int, ...], form: int) -> int:
    """A candidate's pattern as one number."""
    out = KINDS.index(kind) * 2 + base
    for v in vote:
        out = out * 3 + v + 1
    return out * SHAPES + form


def decode(pattern: int) -> tuple[str, bool, tuple[int, ...], int]:
    pattern, form = divmod(pattern, SHAPES)
    vote = []
    for _ in range(LABELERS):
        pattern, v = divmod(pattern, 3)
        vote.append(v - 1)
    return KINDS[pattern // 2], bool(pattern % 2), tuple(reversed(vote)), form


def candidates(text: str) -> list[tuple[str, int, int, bool, int]]:
    """``kind, start, end, base, pattern`` of every base span and of every loose one that
    overlaps none of them."""
    if not _ANY.search(text):
        return []
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    starts, ends = [a for a, _ in taken], list(itertools.accumulate((b for _, b in taken), max))

    def free(span) -> bool:
        k = bisect.bisect_left(starts, span[2])  # base spans that begin before its end
        return not k or ends[k - 1] <= span[1]

    wide = [s for s in dict.fromkeys(wide_spans(text)) if free(s)]
    return [(k, a, b, known, code(k, known, votes(k, text, a, b), shape(k, text[a:b])))
            for spans, known in ((base, True), (wide, False)) for k, a, b in spans]


# --- model -----------------------------------------------------------------------

# What each labeler is expected to say (-1, 0, 1) on false and on true spans, before any data.
EXPECTED = np.array([[[0.45, 0.50, 0.05], [0.05, 0.45, 0.50]],   # strict pattern
                     [[0.50, 0.40, 0.10], [0.05, 0.25, 0.70]],   # structure
                     [[0.45, 0.40, 0.15], [0.10, 0.40, 0.50]],   # gazetteer
                     [[0.30, 0.65, 0.05], [0.02, 0.58, 0.40]],   # context
                     [[0.40, 0.10, 0.50], [0.05, 0.05, 0.90]]])  # edges
STRENGTH, ROUNDS, RIDGE = 30.0, 200, 1e-2


@dataclass
class Reliability:
    """Share of true spans among loose and among base ones, and per labeler the chances of
    its votes on false and true ones."""
    share: np.ndarray = field(default_factory=lambda: np.array([0.5, 0.9]))
    says: np.ndarray = field(default_factory=lambda: EXPECTED.copy())

    def truth(self, base: np.ndarray, vote: np.ndarray) -> np.ndarray:
        """How likely a span with these votes (rows of 0, 1, 2) is true."""
        logs = np.log(self.says)[np.arange(LABELERS), :, vote].sum(1)  # (rows, false/true)
        logs = logs + np.log(np.stack([1 - self.share[base], self.share[base]], 1))
        top = np.exp(logs - logs.max(1, keepdims=True))
        return top[:, 1] / top.sum(1)


def reliabilities(base: np.ndarray, vote: np.ndarray, count: np.ndarray) -> Reliability:
    """Expectation-maximisation over counted vote patterns."""
    model = expected = Reliability()
    for _ in range(ROUNDS if len(vote) else 0):
        true = model.truth(base, vote)
        mass = np.stack([(1 - true) * count, true * count])  # (false/true, rows)
        share = np.array([(mass[1, base == k].sum() + STRENGTH * expected.share[k])
                          / (count[base == k].sum() + STRENGTH) for k in (0, 1)])
        says = np.empty_like(model.says)
        for labeler in range(LABELERS):
            for v in range(3):
                says[labeler, :, v] = mass[:, vote[:, labeler] == v].sum(1) + STRENGTH * EXPECTED[labeler, :, v]
        says /= says.sum(2, keepdims=True)
        settled = np.abs(share - model.share).max() < 1e-12 and np.abs(says - model.says).max() < 1e-12
        model = Reliability(share, says)
        if settled:
            break
    return model


def design(base: np.ndarray, vote: np.ndarray, form: np.ndarray) -> np.ndarray:
    """Classifier features: base or not, a column per labeler and vote against or for, and
    one per shape."""
    out = [np.ones((len(vote), 1)), base[:, None] == 1, vote == 0, vote == 2, form[:, None] == np.arange(SHAPES)]
    return np.concatenate([x.astype(np.float64) for x in out], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Coefficients on soft labels, by Newton's method with halved steps."""
    penalty = np.full(x.shape[1], ridge * max(weight.sum(), 1.0) ** 0.5)
    penalty[0] = 1e-6

    def loss(b):
        z = x @ b
        return (weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (penalty * b * b).sum()

    b = np.zeros(x.shape[1])
    now = loss(b)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -35, 35)))
        slope = x.T @ (weight * (p - y)) + penalty * b
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step, size = np.linalg.solve(curve, slope), 1.0
        while size > 1e-6 and loss(b - size * step) > now:
            size /= 2
        b = b - size * step
        before, now = now, loss(b)
        if before - now <= 1e-12 * max(1.0, abs(now)):
            break
    return b


@dataclass
class Model:
    """Per kind the labelers' reliabilities and the classifier's coefficients."""
    reliability: dict[str, Reliability]
    coefficients: dict[str, np.ndarray]

    def score(self, pattern: int) -> float:
        kind, base, vote, form = decode(pattern)
        x = design(np.array([int(base)]), np.array([vote]) + 1, np.array([form]))
        return float(1 / (1 + np.exp(-np.clip(x @ self.coefficients[kind], -35, 35)[0])))


def all_votes() -> np.ndarray:
    return np.array(list(itertools.product(range(3), repeat=LABELERS)))


def fit(counts: dict[int, int]) -> Model:
    """The model of counted patterns. Every possible vote joins the training with a little
    weight and the likelihood the labelers give it, so none is unknown to the classifier."""
    reliability, coefficients = {}, {}
    anyhow = np.repeat(all_votes(), 2, 0)
    either = np.tile([0, 1], len(anyhow) // 2)
    for kind in KINDS:
        own = sorted((*decode(p)[1:], n) for p, n in counts.items() if decode(p)[0] == kind)
        base, form = (np.array([o[k] for o in own], np.int64) for k in (0, 2))
        vote = np.array([o[1] for o in own], np.int64).reshape(-1, LABELERS) + 1
        n = np.array([o[3] for o in own], np.float64)
        model = reliabilities(base, vote, n)
        x = np.concatenate([design(base, vote, form), design(either, anyhow, np.full(len(anyhow), -1))])
        y = np.concatenate([model.truth(base, vote), model.truth(either, anyhow)])
        weight = np.concatenate([n, np.ones(len(anyhow))])
        reliability[kind], coefficients[kind] = model, logistic(x, y, weight)
    return Model(reliability, coefficients)


def pattern_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``pattern, n`` over all candidates of all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(c[4] for c in candidates(text.as_py()))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
                                             ["pattern", "n"])

    ship_package(docs.sparkSession)
    texts = narrow(docs, id_col, text_col).select("text")
    return texts.mapInArrow(count, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model of a corpus. At most ``4 * 2 * 3^5 * 12`` counts reach the driver."""
    return fit(dict(map(tuple, pattern_counts(docs, id_col, text_col).collect())))


def scores(model: Model) -> dict[int, float]:
    """The classifier's score of every possible pattern (23,328 of them)."""
    out = {}
    for kind in KINDS:
        for base in (0, 1):
            vote, form = np.repeat(all_votes(), SHAPES, 0), np.tile(np.arange(SHAPES), 3**LABELERS)
            z = design(np.full(len(vote), base), vote, form) @ model.coefficients[kind]
            first = code(kind, bool(base), (-1,) * LABELERS, 0)
            out.update(zip(range(first, first + len(vote)), (1 / (1 + np.exp(-np.clip(z, -35, 35)))).tolist()))
    return out


def chosen(text: str, scores: dict[int, float], threshold: float) -> list[tuple[str, int, int, bool, float]]:
    """Base spans, and of the other candidates the best that overlap none before them."""
    found = candidates(text)
    out = [(k, a, b, True, scores[p]) for k, a, b, base, p in found if base]
    taken: list[tuple[int, int]] = []  # sorted, without overlaps
    for s, a, b, k in sorted((-scores[p], a, -b, k) for k, a, b, base, p in found if not base and scores[p] >= threshold):
        at = bisect.bisect_left(taken, (a, -b))
        if (not at or taken[at - 1][1] <= a) and (at == len(taken) or taken[at][0] >= -b):
            taken.insert(at, (a, -b))
            out.append((k, a, -b, False, -s))
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


SPANS = "id long, text string, spans array<struct<kind:string,start:int,end:int,base:boolean,score:double>>"


def find_pii(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``id, text, spans`` of every row; spans by kind as listed, then by place."""
    shared = docs.sparkSession.sparkContext.broadcast(scores(model))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("base", pa.bool_()), ("score", pa.float64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "base", "score"), s)) for s in chosen(t.as_py(), shared.value, threshold)]
                     for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, kind)], ["id", "text", "spans"])

    ship_package(docs.sparkSession)
    return narrow(docs, id_col, text_col).mapInArrow(find, SPANS)


def masked(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``id, text, n_spans`` with every span replaced by ``<kind>``; overlapping ones by the
    first of them."""
    found = find_pii(docs, model, threshold, id_col, text_col)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                out, at = [], 0
                for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= at:
                        out += [t[at:s["start"]], f"<{s['kind']}>"]
                    at = max(at, s["end"])
                texts.append("".join([*out, t[at:]]))
            n = [len(s) for s in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(n, pa.int64())],
                                             ["id", "text", "n_spans"])

    return found.mapInArrow(mask, "id long, text string, n_spans long")
