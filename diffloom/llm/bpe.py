"""BPE encoding and decoding by tree concatenation.

The vocabulary is a public ``tokenizers`` file whose path is a parameter; it is read once by the
driver and broadcast (a fixed few megabytes). A text is cut into words by the file's rules, and
a word is merged pair by pair, lowest rank first; the ids of short words are remembered (in a
bounded table).

Long unsplit runs are encoded as a tree: the halves are encoded on their own, then joined. At a
join a window of the last tokens of the left and the first of the right half is encoded anew,
and grows until its first and last token are those that were there: then every two neighbouring
tokens of the result are what the pair's symbols encode to, which makes the whole the encoding
of the whole run, exactly. Texts above ``LONG_CHARS`` code points are also cut into pieces that
are encoded by different tasks; a cut falls between words where possible, else inside a run of
letters or signs, where the two pieces are joined in the same way.

Nulls are empty texts, and these have no ids. Repeated long texts are encoded once. Columns
of the input stay; ``ids`` (array<int>) is added, and replaces a column of that name.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Callable
from functools import cached_property
from itertools import chain, pairwise

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom.llm.common import fresh

#: Bytes that are merged directly; longer runs are halved.
LEAF_BYTES = 32
#: Windows of more symbols are merged with a heap.
HEAP_SYMBOLS = 96
#: Texts of more code points are cut into pieces of about ``PIECE_CHARS`` for different tasks.
LONG_CHARS = 1 << 16
PIECE_CHARS = 1 << 14
#: Results that a worker remembers: whole words, windows at joins.
REMEMBERED_WORDS = 120_000
REMEMBERED_WINDOWS = 20_000
REMEMBERED_CHARS = 64

# Fixed values of Unicode: below U+0250 these are the letters, numbers and white space; the
# characters of this range are their own NFC form.
_LETTER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t-\r \x85\xa0"
_LATIN = re.compile(r"[\t-\r -~\x85\xa0-ɏ]*")
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")


class _Remembered(dict):
    """Results by argument, made when missing. When full, the results become the older half, from
    which those still in use come back; so frequent ones stay and the table is bounded."""

    def __init__(self, make, most: int = REMEMBERED_WINDOWS):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
            if len(key) > REMEMBERED_CHARS:
                return found
        if 2 * len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


class Bpe:
    """Encoder and decoder of one vocabulary file (its text)."""

    def __init__(self, file: str):
        from tokenizers.pre_tokenizers import ByteLevel

        data = json.loads(file)
        model, self.file = data["model"], file
        self.tokens = {i: t for t, i in model["vocab"].items()} | {a["id"]: a["content"] for a in data["added_tokens"]}
        vocab, self.suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        signs = ByteLevel.alphabet()
        # the printable bytes stand for themselves; the others, in order, for U+0100 and on
        plain = [b for b in range(256) if chr(b) in signs and not 0x7F <= b <= 0xA0 and b != 0xAD and b > 0x20]
        rest = [b for b in range(256) if b not in set(plain)]
        self.sign = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.byte_of = {s: b for b, s in self.sign.items()}
        self.inner = [vocab[self.sign[b]] for b in range(256)]
        self.final = [vocab[self.sign[b] + self.suffix] for b in range(256)]
        self.base = {i: (i,) for i in (*self.inner, *self.final)}
        self.rank, self.made = {}, []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            new = vocab[a + b]
            self.rank[vocab[a], vocab[b]] = rank
            self.made.append(new)
            self.base.setdefault(new, self.base[vocab[a]] + self.base[vocab[b]])
        self.added = {a["content"]: a["id"] for a in data["added_tokens"]}
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") \
            if self.added else None
        #: as bytes of 32-bit ids: a text's ids are then one join of its words'
        self.ids_of_word = _Remembered(lambda w: array("i", self.tree(w.encode("utf-8", "surrogatepass"))).tobytes(),
                                        REMEMBERED_WORDS)
        self.ids_of_window = _Remembered(lambda tokens: self.merge([s for t in tokens for s in self.base[t]]))
        self.table = np.array([self.tokens.get(i, "") for i in range(max(self.tokens) + 1)], object)

    @cached_property
    def library(self):
        """The library's normal form and word rules, for texts outside the plain range."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.file)

    # one unsplit run

    def symbols(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "surrogatepass")
        return [self.inner[b] for b in raw[:-1]] + [self.final[b] for b in raw[-1:]]

    def merge(self, ids: list[int]) -> tuple[int, ...]:
        """Merges the pair of lowest rank, the leftmost first, until there is none."""
        if len(ids) > HEAP_SYMBOLS:
            return self._merge_long(ids)
        ids, made, rank_of, none = list(ids), self.made, self.rank.get, len(self.made)
        ranks = [rank_of(p, none) for p in pairwise(ids)]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            at = ranks.index(least)
            ids[at] = new = made[least]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank_of((ids[at - 1], new), none)
            if at < len(ranks):
                ranks[at] = rank_of((new, ids[at + 1]), none)
        return tuple(ids)

    def _merge_long(self, ids: list[int]) -> tuple[int, ...]:
        """The same with a heap, for windows that grow large."""
        ids, n, rank = list(ids), len(ids), self.rank
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p], i) for i, p in enumerate(pairwise(ids)) if p in rank]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = right[i]
            if ids[i] is None or j >= n or rank.get((ids[i], ids[j])) != r:
                continue
            ids[i], ids[j] = self.made[r], None
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (p := rank.get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (p, i))
            if (h := left[i]) >= 0 and (p := rank.get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (p, h))
        return tuple(i for i in ids if i is not None)

    def join(self, a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of two neighbouring parts of one run, from the encodings of each."""
        if not a or not b:
            return a + b
        k, m, n = 1, len(a), len(b)
        while True:
            window = self.ids_of_window[a[-k:] + b[:k]]
            if (k >= m or window[0] == a[-k]) and (k >= n or window[-1] == b[k - 1]):
                return a[:max(0, m - k)] + window + b[k:]
            k *= 2

    def tree(self, raw: bytes, open_end: bool = False) -> tuple[int, ...]:
        """The encoding of one run; with an open end, of a part that the run's end does not follow."""
        if len(raw) <= LEAF_BYTES:
            final = self.inner if open_end else self.final
            return self.merge([self.inner[b] for b in raw[:-1]] + [final[b] for b in raw[-1:]])
        half = len(raw) // 2
        return self.join(self.tree(raw[:half], True), self.tree(raw[half:], open_end))

    # whole texts

    def words(self, text: str) -> list[str]:
        """The unsplit runs of a text without added tokens."""
        if _LATIN.fullmatch(text):
            return _WORD.findall(text.lower())
        text = self.library.normalizer.normalize_str(text)
        raw = self.library.pre_tokenizer.pre_tokenize_str(text)
        return [bytes(self.byte_of[c] for c in w).decode("utf-8", "surrogatepass") for w, _ in raw]

    def segments(self, text: str) -> list[str]:
        """The text cut at the added tokens; these are at the odd places."""
        return self.split_added.split(text) if self.split_added and "<|" in text else [text]

    def encode(self, text: str) -> np.ndarray:
        segments = self.segments(text)
        found = [array("i", [self.added[s]]).tobytes() if k % 2 else b"".join(map(self.ids_of_word.__getitem__, self.words(s)))
                 for k, s in enumerate(segments)]
        return np.frombuffer(found[0] if len(found) == 1 else b"".join(found), np.int32)

    def decode(self, ids) -> str:
        """Token strings joined by one space, as a file without a decoder has it; unknown ids are left out."""
        ids = np.asarray(ids, np.int64)
        known = (ids >= 0) & (ids < len(self.table))
        return " ".join([t for t in self.table[ids if known.all() else ids[known]].tolist() if t])

    def encode_piece(self, text: str, open_left: bool, open_right: bool) -> dict:
        """Ids of a piece, and how many of them are in its first and last run where these are open:
        ``head`` of an open left side, ``tail`` of an open right side, ``one`` if they are the same run."""
        runs = [self.added[s] if k % 2 else w for k, s in enumerate(self.segments(text))
                for w in ([s] if k % 2 else self.words(s))]
        parts = [(r,) if isinstance(r, int) else self.tree(r.encode("utf-8", "surrogatepass")) for r in runs]
        if open_right:
            parts[-1] = self.tree(runs[-1].encode("utf-8", "surrogatepass"), True)
        return {"ids": tuple(chain.from_iterable(parts)), "head": len(parts[0]) if open_left else 0,
                "tail": len(parts[-1]) if open_right else 0, "one": len(parts) == 1}

    def join_pieces(self, a: dict, b: dict) -> dict:
        if not a["tail"]:
            return {"ids": a["ids"] + b["ids"], "head": a["head"], "tail": b["tail"], "one": False}
        cut = len(a["ids"]) - a["tail"]
        run = self.join(a["ids"][cut:], b["ids"][: b["head"]])
        return {"ids": a["ids"][:cut] + run + b["ids"][b["head"]:],
                "head": len(run) if a["one"] and a["head"] else a["head"],
                "tail": len(run) if b["one"] and b["tail"] else b["tail"], "one": a["one"] and b["one"]}

    def join_all(self, pieces: list[dict]) -> tuple[int, ...]:
        while len(pieces) > 1:
            pieces = [self.join_pieces(*pieces[k:k + 2]) if k + 1 < len(pieces) else pieces[k]
                      for k in range(0, len(pieces), 2)]
        return pieces[0]["ids"] if pieces else ()


def cut(text: str, size: int) -> list[tuple[str, bool, bool]]:
    """Pieces of about ``size`` code points: (text, open on the left, open on the right). A cut is
    made before ASCII white space, or, if there is none for ``size`` more, inside a run of
    letters or of other signs, away from what the word rules or the normal form tie together."""
    out, begin, open_left = [], 0, False
    while len(text) - begin > size:
        at, soft = _cut_at(text, begin + size, min(len(text), begin + 2 * size))
        if at is None:
            break
        out.append((text[begin:at], open_left, soft))
        begin, open_left = at, soft
    out.append((text[begin:], open_left, False))
    return out


_GAP = re.compile("[\t\n\r ]")
_LOOSE = re.compile("[^\t-\r \x85\xa0]{16}")


def _kind(c: str) -> str:
    return "" if c in "'<|>" or c.isspace() or unicodedata.category(c)[0] in "MCN" else \
        "L" if unicodedata.category(c)[0] == "L" else "S"


def _cut_at(text: str, low: int, high: int) -> tuple[int | None, bool]:
    gap = _GAP.search(text, low, high)
    if gap:
        return gap.start(), False
    for at in range(low, len(text) - 8):
        near = text[at - 8:at + 8]
        kinds = {_kind(c) for c in near}
        if len(kinds) == 1 and kinds <= {"L", "S"} and not any(0x1100 <= ord(c) <= 0x11FF for c in near):
            return at, True
        if text[at] in "\t\n\r ":
            return at, False
    return None, False


_LOADED: dict[int, Bpe] = {}


def load(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file, broadcast: a fixed size, a few megabytes."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _bpe(file: Broadcast) -> Bpe:
    text = file.value
    if hash(text) not in _LOADED:
        _LOADED[hash(text)] = Bpe(text)
    return _LOADED[hash(text)]


def encode(df: DataFrame, file: Broadcast, text: str = "text", long_chars: int = LONG_CHARS,
           piece_chars: int = PIECE_CHARS, decoded: str | None = None,
           then: tuple[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """``df`` with the ids of ``text`` as ``ids``; with the name ``decoded``, also what they decode
    to (a column of that name is replaced), in the same pass over the texts.

    ``then``: a name and a function of the struct (ids, text): its result is kept under that name in
    place of ``ids``. A pandas UDF is applied in the worker that encodes, so ids that only serve to
    derive something never leave it."""

    @F.pandas_udf("ids array<int>, text string")
    def whole(column: pd.Series) -> pd.DataFrame:
        bpe = _bpe(file)
        ids = [bpe.encode(t) for t in column]
        return pd.DataFrame({"ids": pd.Series(ids, dtype=object),
                             "text": pd.Series([bpe.decode(i) if decoded or then else None for i in ids], dtype=object)})

    @F.pandas_udf("array<struct<piece:string,open_left:boolean,open_right:boolean>>")
    def pieces_of(column: pd.Series) -> pd.Series:
        return pd.Series([[{"piece": p, "open_left": a, "open_right": b} for p, a, b in cut(t, piece_chars)]
                          for t in column], dtype=object)

    @F.pandas_udf("ids array<int>, head int, tail int, one boolean")
    def encoded(piece: pd.Series, left: pd.Series, right: pd.Series) -> pd.DataFrame:
        bpe = _bpe(file)
        return pd.DataFrame([bpe.encode_piece(*p) for p in zip(piece, left, right)],
                            columns=["ids", "head", "tail", "one"])

    def joined(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        parts = [{"ids": tuple(i), "head": h, "tail": t, "one": o} for i, h, t, o in
                 zip(rows["ids"], rows["head"], rows["tail"], rows["one"])]
        return pd.DataFrame({"digest": [key[0]], "ids": [list(_bpe(file).join_all(parts))]})

    new = ("ids", decoded) if then is None else (then[0],)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in new]
    column = F.coalesce(F.col(text), F.lit(""))
    both = fresh(df, "__both")
    back = [F.col(f"{both}.text").alias(decoded)] if decoded else []
    short = df.filter(F.length(column) <= long_chars)
    if then is None:
        short = short.withColumn(both, whole(column)).select(*kept, F.col(f"{both}.ids").alias("ids"), *back)
    else:
        short = short.select(*kept, then[1](whole(column)).alias(then[0]))
    long = df.filter(F.length(column) > long_chars)
    texts = long.select(F.sha2(F.col(text), 256).alias("digest"), F.col(text).alias("text")).dropDuplicates(["digest"])
    cuts = texts.select("digest", F.posexplode(pieces_of("text")).alias("pos", "p"))
    done = (cuts.repartition("digest", "pos")
            .select("digest", "pos", encoded("p.piece", "p.open_left", "p.open_right").alias("e"))
            .select("digest", "pos", "e.*").groupBy("digest").applyInPandas(joined, "digest string, ids array<int>"))
    digest, ids = fresh(df, "__digest"), fresh(df, "__ids")
    back = [decode(F.col(ids), file).alias(decoded)] if decoded else []
    found = (long.withColumn(digest, F.sha2(F.col(text), 256))
             .join(done.select(F.col("digest").alias(digest), F.col("ids").alias(ids)), digest))
    if then is None:
        found = found.select(*kept, F.col(ids).alias("ids"), *back)
    else:
        found = found.select(*kept, then[1](F.struct(F.col(ids).alias("ids"), decode(F.col(ids), file).alias("text"))).alias(then[0]))
    return short.unionByName(found)


def decode(ids: Column, file: Broadcast) -> Column:
    """The text of each array of ids, special tokens included; null for null."""

    @F.pandas_udf("string")
    def decoded(column: pd.Series) -> pd.Series:
        bpe = _bpe(file)
        return pd.Series([None if i is None else bpe.decode(i) for i in column], dtype=object)

    return decoded(ids)
