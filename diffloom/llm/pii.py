"""Personal data by base patterns and a semi-Markov conditional random field.

The base finds e-mail addresses, IP addresses, card numbers and phone numbers by fixed patterns.
The field then reads the neighbourhood of every digit and ``@``, and of every value after a cue such
as ``password=``, as a row of chunks (white space and ``"'=:;,<>`` part them). A chunk with neither
digit nor ``@`` is a candidate directly behind a cue only. A candidate segment is one to ``MAX_CHUNKS`` neighbouring chunks;
features of the whole segment (its shape, counts, check digit, the word before it) score it as
each kind, and dynamic programming over segments of so many chunks, each of any length, chooses boundaries and kinds
of the whole neighbourhood together. Besides the base kinds it knows ``secret`` (passwords,
tokens, keys). Segments that touch no base span are added to the base spans, which all stay.

The weights are learned here, by maximum likelihood with forward-backward sums, from a bounded
sample of ``SAMPLE_DOCUMENTS`` documents with digits, ``@`` or cues: segments that a base pattern matches when they
stand alone, and values after an unmistakable cue, are the labels; the features that repeat the base patterns and the cues are
left out of every other training example, so that shapes count as well. Values after a cue serve a
second time with letters for their digits, so that a secret need not have a digit.

All is decided inside one row. Nulls and empty texts have no spans. Equal rows get equal spans.
Texts are read whole, in time linear in their length.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diffloom.llm.common import fresh

KINDS = ("email", "ip", "card", "phone", "secret")
ORDER = {k: n for n, k in enumerate(KINDS)}
#: A segment is at most so many chunks.
MAX_CHUNKS = 6
#: Chunks of context on either side of one with a digit or an ``@``, or behind a cue.
CONTEXT = 2
SAMPLE_DOCUMENTS = 1500
#: A segment must beat leaving its chunks alone by so much (log odds).
MARGIN = 2.0

Span = tuple[int, int, str]

_ANY = re.compile("[0-9@]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile("[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append((begin, m.end(), "email"))
        last = m.end() if m else at + 1
        at = text.find("@", last)
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns: leftmost, not overlapping inside a kind; by start, then kind."""
    if not _ANY.search(text):
        return []
    out = _emails(text)
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) < 3 or len(p) == 3 and int(p) <= 255 for part in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], ORDER[s[2]]))


# neighbourhoods and their segments

_BREAK = re.compile(r"""[\s"'=:;,<>]+""")
_WORD_BEFORE = re.compile(r"[^\W\d_]{1,20}$")
_CUE_WORDS = r"""(?i)\b(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)["']?\s*+[=:]"""
_CUE = re.compile(_CUE_WORDS + r"""\s*+["']?""")
_CUES = {"pass": "password passwd pwd token secret key apikey", "tel": "phone tel call fax mobile",
         "card": "card visa credit", "net": "ip host server", "mail": "mail email"}
_CUE_OF = {w: c for c, ws in _CUES.items() for w in ws.split()}
_HEX = re.compile("(?=.*[0-9])[0-9a-f]+|(?=.*[0-9])[0-9A-F]+")

@dataclass
class Hood:
    """Chunk spans of a neighbourhood, its candidate segments (first, last chunk) and their features."""

    chunks: list[tuple[int, int]]
    segments: list[tuple[int, int]]
    features: np.ndarray


def _cued(text: str) -> list[int]:
    """Where the values after cues begin."""
    return [m.end() for m in _CUE.finditer(text) if m.end() < len(text) and not _BREAK.match(text[m.end()])]


def _chunks(text: str) -> list[list[tuple[int, int]]]:
    """Neighbourhoods of the chunks with a digit or an ``@`` or behind a cue, each a list of chunk spans."""
    hoods: list[list[tuple[int, int]]] = []
    cued = _cued(text)
    passed, digit = 0, _ANY.search(text)

    def following(at: int) -> int:
        """The first place from ``at`` on that a neighbourhood is read around, or -1."""
        nonlocal passed, digit
        if digit and digit.start() < at:
            digit = _ANY.search(text, at)
        while passed < len(cued) and cued[passed] < at:
            passed += 1
        places = [m.start() for m in [digit] if m] + cued[passed:passed + 1]
        return min(places, default=-1)

    place = following(0)
    while place >= 0:
        begin = place
        floor = hoods[-1][-1][1] if hoods else 0
        while begin > floor and not _BREAK.match(text[begin - 1]):
            begin -= 1
        stop = _BREAK.search(text, place)
        end = stop.start() if stop else len(text)
        before, at, near = [], begin, False
        while len(before) < CONTEXT:
            edge = at
            while edge > floor and _BREAK.match(text[edge - 1]):
                edge -= 1
            left = edge
            while left > floor and not _BREAK.match(text[left - 1]):
                left -= 1
            if left == edge:
                near = bool(hoods)  # nothing but the gap lies between
                break
            before.insert(0, (left, edge))
            at = left
        own = [*before, (begin, end)]
        if hoods and near:
            hoods[-1] += own
        else:
            hoods.append(own)
        after = hoods[-1]
        place = following(end)
        at = end
        for _ in range(CONTEXT):
            gap = _BREAK.match(text, at)
            if not gap or gap.end() >= len(text) or 0 <= place < gap.end():
                break
            stop = _BREAK.search(text, gap.end())
            right = stop.start() if stop else len(text)
            if 0 <= place < right:
                break
            after.append((gap.end(), right))
            at = right
    return hoods


def _trim(text: str, begin: int, end: int) -> tuple[int, int]:
    while end > begin and text[end - 1] in ".!?,|*":
        end -= 1
    while begin < end and text[begin] in ".!?,|*":
        begin += 1
    return begin, end


FEATURES = ("one", "digits 1-4", "digits 5-8", "digits 9", "digits 10-13", "digits 14-19", "digits 20+", "all digits",
            "digits and signs", "letters and digits", "hex 16+", "long mixed", "at", "dots 1", "dots 3", "dots other",
            "dash", "brackets", "plus first", "luhn 14-19", "byte parts", "groups of four", "groups 3-3-4", "top domain",
            "words inside", "chunks 1", "chunks 2-3", "chunks 4+", "quoted", "after =", "letters only around",
            "cue pass", "cue tel", "cue card", "cue net", "cue mail", "like email", "like ip", "like card", "like phone",
            "cue given")
_AT = {f: k for k, f in enumerate(FEATURES)}
#: What the labels were made from; left out of every other training example.
_GIVEN = [_AT[f] for f in ("like email", "like ip", "like card", "like phone", "cue given")]


def _features(text: str, begin: int, end: int, n_chunks: int) -> list[str]:
    s = text[begin:end]
    digits = "".join(c for c in s if c in "0123456789")
    letters = sum(c.isalpha() for c in s)
    n = len(digits)
    out = ["one", "chunks 1" if n_chunks == 1 else "chunks 2-3" if n_chunks < 4 else "chunks 4+"]
    if n:
        out.append("digits 1-4" if n < 5 else "digits 5-8" if n < 9 else "digits 9" if n < 10 else
                   "digits 10-13" if n < 14 else "digits 14-19" if n < 20 else "digits 20+")
    if n == len(s):
        out.append("all digits")
    elif not letters and n:
        out.append("digits and signs")
    elif n and letters:
        out.append("letters and digits")
    if len(s) >= 16 and _HEX.fullmatch(s):
        out.append("hex 16+")
    elif len(s) >= 16 and n >= 3 and letters >= 3 and s.replace("_", "").replace("-", "").isalnum():
        out.append("long mixed")
    dots = s.count(".")
    out += ["at"] * ("@" in s) + ([f"dots {dots}" if dots in (1, 3) else "dots other"] if dots else [])
    out += ["dash"] * ("-" in s) + ["brackets"] * ("(" in s and ")" in s) + ["plus first"] * s.startswith("+")
    groups = re.findall("[0-9]+", s)
    sizes = [len(g) for g in groups]
    if 14 <= n <= 19 and luhn(digits):
        out.append("luhn 14-19")
    if len(groups) == 4 and dots == 3 and all(len(g) < 4 and int(g) < 256 for g in groups):
        out.append("byte parts")
    if len(sizes) >= 3 and set(sizes) == {4}:
        out.append("groups of four")
    if sizes[-3:] == [3, 3, 4]:
        out.append("groups 3-3-4")
    if re.search(r"\.[A-Za-z]{2,6}$", s):
        out.append("top domain")
    if n_chunks > 1 and letters:
        out.append("words inside")
    if begin and text[begin - 1] in "\"'":
        out.append("quoted")
    left = text[max(0, begin - 24):begin].rstrip(" \"'")
    if left.endswith(("=", ":")):
        out.append("after =")
    word = _WORD_BEFORE.search(left.rstrip(" =:\"'"))
    if word and (cue := _CUE_OF.get(word[0].lower())):
        out.append(f"cue {cue}")
    if not n and "@" not in s:
        out.append("letters only around")
    return out


def hoods_of(text: str) -> list[Hood]:
    out, cued = [], set(_cued(text))
    for chunks in _chunks(text):
        segments, rows = [], []
        for i in range(len(chunks)):
            for j in range(i, min(i + MAX_CHUNKS, len(chunks))):
                begin, end = _trim(text, chunks[i][0], chunks[j][1])
                if end - begin < 4:
                    continue
                behind = chunks[i][0] in cued
                if not _ANY.search(text, begin, end) and not (behind and j == i) or j > i and not (
                        _ANY.search(text, *chunks[i]) and _ANY.search(text, *chunks[j])):
                    continue
                names = _features(text, begin, end, j - i + 1)
                names += [f"like {k}" for a, b, k in base_spans(text[begin:end]) if b - a == end - begin]
                if behind and end - begin >= 8:
                    names.append("cue given")
                row = np.zeros(len(FEATURES))
                row[[_AT[f] for f in names]] = 1.0
                segments.append((i, j))
                rows.append(row)
        if segments:
            out.append(Hood(chunks, segments, np.array(rows)))
    return out


# the field: segment scores are features @ weights, chunks outside score 0, kinds follow each other
# with the weights of ``follow`` (the last kind is "outside")

OUT = len(KINDS)


@dataclass
class Field:
    weights: np.ndarray
    follow: np.ndarray

    def _moves(self, hood: Hood, features: np.ndarray, margin: float = 0.0) -> list[list[tuple[int, int, int, float]]]:
        """For each end position: (begin, kind, segment, score); a segment of -1 is one chunk outside."""
        scores = features @ self.weights - margin
        ends: list[list] = [[] for _ in range(len(hood.chunks) + 1)]
        for n in range(len(hood.chunks)):
            ends[n + 1].append((n, OUT, -1, 0.0))
        for s, (i, j) in enumerate(hood.segments):
            for kind in range(OUT):
                ends[j + 1].append((i, kind, s, scores[s, kind]))
        return ends

    def best(self, hood: Hood, margin: float = MARGIN) -> list[tuple[int, int]]:
        """(segment, kind) of the best reading."""
        n = len(hood.chunks)
        value = np.full((n + 1, OUT + 1), -np.inf)
        value[0, OUT] = 0.0
        back: dict[tuple[int, int], tuple[int, int, int]] = {}
        for end, moves in enumerate(self._moves(hood, hood.features, margin)):
            for begin, kind, segment, score in moves:
                before = value[begin] + self.follow[:, kind]
                k = int(np.argmax(before))
                if before[k] + score > value[end, kind]:
                    value[end, kind] = before[k] + score
                    back[end, kind] = (begin, k, segment)
        out, at, kind = [], n, int(np.argmax(value[n]))
        while at:
            begin, previous, segment = back[at, kind]
            if segment >= 0:
                out.append((segment, kind))
            at, kind = begin, previous
        return out[::-1]

    def gradient(self, hood: Hood, features: np.ndarray, gold: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Of the log likelihood of the reading ``gold``: found minus expected counts."""
        ends, n = self._moves(hood, features), len(hood.chunks)
        ahead = np.full((n + 1, OUT + 1), -np.inf)
        ahead[0, OUT] = 0.0
        for end, moves in enumerate(ends):
            for begin, kind, _, score in moves:
                ahead[end, kind] = np.logaddexp(ahead[end, kind], np.logaddexp.reduce(ahead[begin] + self.follow[:, kind]) + score)
        total = np.logaddexp.reduce(ahead[n])
        behind = np.full((n + 1, OUT + 1), -np.inf)
        behind[n] = 0.0
        dw, df = np.zeros_like(self.weights), np.zeros_like(self.follow)
        for end in range(n, 0, -1):
            for begin, kind, segment, score in ends[end]:
                tail = score + behind[end, kind]
                behind[begin] = np.logaddexp(behind[begin], self.follow[:, kind] + tail)
                p = np.exp(ahead[begin] + self.follow[:, kind] + tail - total)
                df[:, kind] -= p
                if segment >= 0:
                    dw[:, kind] -= p.sum() * features[segment]
        at, previous = 0, OUT
        for segment, kind in [*gold, (-1, OUT)]:
            first, last = hood.segments[segment] if segment >= 0 else (n, n)
            for _ in range(at, first):
                df[previous, OUT] += 1
                previous = OUT
            if segment >= 0:
                df[previous, kind] += 1
                dw[:, kind] += features[segment]
                previous, at = kind, last + 1
        return dw, df


def gold_reading(hood: Hood) -> list[tuple[int, int]]:
    """The labelled segments: those that a base pattern matches when they stand alone, and values
    after a cue; the earlier and longer first."""
    found = []
    for s, (i, j) in enumerate(hood.segments):
        names = {FEATURES[k] for k in np.flatnonzero(hood.features[s])}
        kind = next((k for k in KINDS[:4] if f"like {k}" in names), "secret" if "cue given" in names and i == j else None)
        if kind:
            found.append((i, -j, ORDER[kind], s))
    out, at = [], 0
    for i, j, kind, s in sorted(found):
        if i >= at:
            out.append((s, kind))
            at = 1 - j
    return out


_AS_LETTERS = str.maketrans("0123456789@", "abcdefghija")


def _lettered(text: str) -> str:
    """The text with letters in place of the digits of values after cues: secrets without a digit, which are rare
    in the sample, to learn from."""
    out, at = [], 0
    for begin in _cued(text):
        if begin >= at:
            stop = _BREAK.search(text, begin)
            end = stop.start() if stop else len(text)
            out += [text[at:begin], text[begin:end].translate(_AS_LETTERS)]
            at = end
    return "".join([*out, text[at:]])


def train(texts: list[str], least_steps: int = 10_000, rate: float = 0.3, decay: float = 1e-3, seed: int = 7) -> Field:
    """Maximum likelihood by stochastic gradient steps (AdaGrad) over the texts' neighbourhoods, in as
    many whole passes as make ``least_steps``."""
    field = Field(np.zeros((len(FEATURES), OUT)), np.zeros((OUT + 1, OUT + 1)))
    examples = [(h, gold_reading(h)) for t in texts for h in hoods_of(t) if len(h.chunks) <= 40]
    plain = [(h, gold_reading(h)) for t in texts if _CUE.search(t) for h in hoods_of(_lettered(t)) if len(h.chunks) <= 40]
    examples += [(h, gold) for h, gold in plain if any(h.features[s, _AT["letters only around"]] for s, _ in gold)]
    rng = np.random.default_rng(seed)
    sums = [np.full_like(field.weights, 1e-2), np.full_like(field.follow, 1e-2)]
    for _ in range(-(-least_steps // max(1, len(examples)))):
        for k in rng.permutation(len(examples)):
            hood, gold = examples[k]
            features = hood.features
            if rng.random() < 0.5:
                features = features.copy()
                features[:, _GIVEN] = 0.0
            for part, sum_, step in zip((field.weights, field.follow), sums, field.gradient(hood, features, gold)):
                step = step - decay * part
                sum_ += step * step
                part += rate * step / np.sqrt(sum_)
    return field


def sample_texts(df: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = SAMPLE_DOCUMENTS) -> list[str]:
    """About ``n`` texts with digits, an ``@`` or a cue, chosen by a hash of id and length, never more than
    2 ``n``: the bounded sample that the field is fitted to. The first pass only counts them."""
    rows = df.filter(F.col(text).rlike(f"[0-9@]|{_CUE_WORDS}") & (F.length(text) <= 20_000)).select(
        F.xxhash64(F.col(id_col), F.length(text)).alias("h"), F.col(text).alias("t"))
    count = max(1, rows.count())
    share = min(1.0, n / count)
    chosen = rows.filter(F.pmod("h", F.lit(2**31)) < int(share * 2**31))
    return [r.t for r in chosen.orderBy("h", "t").limit(2 * n).collect()]


def fit(df: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = SAMPLE_DOCUMENTS) -> Broadcast:
    """The field fitted to a bounded sample of ``df``, broadcast (a few kilobytes)."""
    return df.sparkSession.sparkContext.broadcast(train(sample_texts(df, id_col, text, n)))


def find(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by start, then kind as listed."""
    base = base_spans(text)
    if not _ANY.search(text) and not _CUE.search(text):
        return base, base
    added = []
    for hood in hoods_of(text):
        for segment, kind in field.best(hood):
            i, j = hood.segments[segment]
            begin, end = _trim(text, hood.chunks[i][0], hood.chunks[j][1])
            if not any(a < end and begin < b for a, b, _ in base):
                added.append((begin, end, KINDS[kind]))
    return base, sorted([*base, *added], key=lambda s: (s[0], ORDER[s[2]]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, as its first kind in brackets."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def spans(text: Column, field: Broadcast) -> Column:
    """A struct of ``SCHEMA`` for each text. Counts and digest are those of the base spans."""

    @F.pandas_udf(SCHEMA)
    def found(column: pd.Series) -> pd.DataFrame:
        rows = []
        for t in column:
            base, every = find(t, field.value) if isinstance(t, str) else ([], [])
            kinds = [k for _, _, k in base]
            rows.append((*(kinds.count(k) for k in KINDS[:4]), hashlib.sha256(listed(base).encode()).hexdigest(), listed(every)))
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return found(text)


def redacted(df: DataFrame, field: Broadcast, text: str = "text") -> DataFrame:
    """``df`` with every span of ``text`` replaced by its kind; nulls stay null."""

    @F.pandas_udf("string")
    def cleaned(column: pd.Series) -> pd.Series:
        return pd.Series([redact(t, find(t, field.value)[1]) if isinstance(t, str) else None for t in column], dtype=object)

    name = fresh(df, "__clean")
    return df.withColumn(name, cleaned(F.col(text))).withColumn(text, F.col(name)).drop(name)
