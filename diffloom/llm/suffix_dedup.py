"""Repeated passages by a sparse suffix array.

Words are runs of other than ASCII white space. Of a text's suffixes only those are kept that begin
at a minimiser: the least 3-word hash of some ``WINDOW`` (16) neighbouring ones. A passage of
``MIN_WORDS`` (50) words holds one of its own among its first 16 positions, at the same place in
every copy, so each copy keeps a suffix there that shares at least ``PREFIX`` (35) words.

The kept suffixes are sorted by their first 35 words (as a hash) and then by document, over range
partitions, so that a beginning that a third of all documents share is split over many tasks.
Neighbours of different documents with one beginning are compared; suffixes of shared beginnings
are sorted and compared once more with their first 50 words, so that copies of a whole passage meet
even where others share a part of it. Each suffix meets its neighbours only, never all that share
its beginning. Matches of two documents on one diagonal are merged; the words of both texts around
the merged match are compared to extend it left and right, and the words inside are compared by a
second hash. Matches of ``MIN_WORDS`` words or more count. A suffix of a shared beginning whose first
50 words nobody shares may still lie inside a shared passage that begins before it: for these, and
all that share their beginning, the 50-word windows that begin 2, 4, ... 14 words before are sorted
and compared as well.

So every document with a passage of 51 words or more that another document has is found. The edges
of a span are those of its matches with neighbours: another document may share a few words more.

Result: (doc_id, start, end in code points, n_words, other_doc_id, other_start), one row for each
repeated span. Overlapping spans of one document are merged; the other document is that of its
longest match.

Nulls, empty texts and texts of fewer than 50 words have no spans. Rows of one id are one document:
a text repeated under its own id is no match. Rows without an id are a document for each
different text, and come out with a null id. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from diffloom.llm.common import Words, mix, steps, stream, utf8
from diffloom.session import materialize

MIN_WORDS = 50
WINDOW = 16
GRAM = 3
PREFIX = MIN_WORDS - WINDOW + 1
#: Words that are compared beyond either end of a merged match.
REACH = 32
#: Suffixes that one task sorts and compares.
TASK_ROWS = 1_000_000

SUFFIX = "b1 long, whole long, doc long, pos int"
COLUMNS = ["b1", "whole", "doc", "pos"]


def _slide(values: np.ndarray, n: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of each ``n`` neighbours; by doubling."""
    size = 1
    while 2 * size <= n:
        values = pick(values[:-size], values[size:])
        size *= 2
    return pick(values[: len(values) - (n - size)], values[n - size:]) if n > size else values


def minimisers(words: Words, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Indices of the words where some window of ``window`` neighbouring grams has its least hash."""
    n = len(words)
    if n < window + gram - 1:
        return np.zeros(0, np.int64)
    at, h = words.windows(gram)
    grams = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    grams[at] = np.maximum(h, np.uint64(1))
    least = _slide(grams, window, np.minimum)
    whole = np.zeros(len(least), bool)
    inside = len(least) - gram + 1
    whole[:inside] = words.text[:inside] == words.text[window + gram - 2:]
    least = np.where(whole, least, np.uint64(0))
    padded = np.concatenate((np.zeros(window - 1, np.uint64), least, np.zeros(window - 1, np.uint64)))
    return np.flatnonzero((_slide(padded, window, np.maximum) == grams) & (grams < np.iinfo(np.uint64).max))


def _hashed(words: Words, begin: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of the ``n`` words from each index."""
    keys = stream(seed, n) | np.uint64(1)
    out = np.zeros(len(begin), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out += words.hash[begin + k] * keys[k]
        return mix(out)


def suffixes(texts: list[bytes], docs: np.ndarray) -> pd.DataFrame:
    """The kept suffixes: hash of the prefix, hash of ``MIN_WORDS`` words (0 where the text ends before)."""
    words = Words(texts)
    at = minimisers(words)
    at = at[at + PREFIX <= len(words)]
    at = at[words.text[at + PREFIX - 1] == words.text[at]]
    far = at + MIN_WORDS - 1
    ok = far < len(words)
    ok[ok] = words.text[far[ok]] == words.text[at[ok]]
    whole = np.zeros(len(at), np.uint64)
    whole[ok] = _hashed(words, at[ok], MIN_WORDS, 300) | np.uint64(1)
    return pd.DataFrame({"b1": _hashed(words, at, PREFIX, 200).view(np.int64), "whole": whole.view(np.int64),
                         "doc": docs[words.text[at]], "pos": (at - words.first[words.text[at]]).astype(np.int32)})


COMPARED = f"kind int, part int, {SUFFIX}, doc2 long, pos2 int, whole2 long"
PAIR, SHARED, EDGE, LONE = 0, 1, 2, 3
#: Words from one window to the next before a lone suffix.
WINDOW_STEP = 2


def neighbours(rows: DataFrame, key: str, name: str, lone: bool = False) -> DataFrame:
    """Sorts suffixes by ``key``, document and place over range partitions and compares neighbours.
    Kinds of rows: ``PAIR``: two suffixes with one key in different documents; ``SHARED``: a suffix
    whose key another document has too (or may have in the next partition); ``EDGE``: the first and
    the last of a partition; ``LONE``: a suffix without such a neighbour in its partition."""
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // TASK_ROWS))

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = [b for b in batches if len(b)]
        if not kept:
            return
        own = pd.concat(kept, ignore_index=True)
        v = {c: own[c].to_numpy() for c in COLUMNS}
        n, part, k = len(own), TaskContext.get().partitionId(), v[key]
        new_doc = np.concatenate(([True], (k[1:] != k[:-1]) | (v["doc"][1:] != v["doc"][:-1])))
        begins = np.flatnonzero(new_doc)  # of stretches of one document under one key (text that repeats itself)
        size, stretch = np.diff(np.append(begins, n)), np.cumsum(new_doc) - 1
        same = np.concatenate(([False], k[begins[1:]] == k[begins[:-1]], [False]))  # as the stretch before
        has_p, has_f = same[stretch], same[stretch + 1]
        place = np.arange(n) - begins[stretch]

        def beside(rows_: np.ndarray, other: np.ndarray) -> np.ndarray:
            """The row of the neighbouring stretch at the same place, counted round."""
            return begins[other] + place[rows_] % size[other]

        down, up = np.flatnonzero(has_p), np.flatnonzero(has_f)
        low = np.concatenate((beside(down, stretch[down] - 1), up))
        high = np.concatenate((down, beside(up, stretch[up] + 1)))
        pair = np.unique(low * n + high)
        low, high = pair // n, pair % n
        shared = has_p | has_f | (k == k[0]) | (k == k[-1])
        for kind, at, other in ((PAIR, low, high), (SHARED, np.flatnonzero(shared), None), (EDGE, np.unique([0, n - 1]), None),
                                (LONE, np.flatnonzero(~has_p & ~has_f) if lone else low[:0], None)):
            out = own.iloc[at].reset_index(drop=True)
            out["kind"], out["part"] = kind, part
            out["doc2"] = v["doc"][other] if other is not None else 0
            out["pos2"] = v["pos"][other] if other is not None else 0
            out["whole2"] = v["whole"][other] if other is not None else 0
            yield out[["kind", "part", *COLUMNS, "doc2", "pos2", "whole2"]]

    dealt = rows.select(*COLUMNS).repartitionByRange(parts, key, "doc", "pos").sortWithinPartitions(key, "doc", "pos")
    return materialize(dealt.mapInPandas(compared, COMPARED), name)


def pairs_of(found: DataFrame, key: str) -> DataFrame:
    """The pairs, with those of the last suffix of a partition and the first of the next (two rows a
    partition are looked at for these)."""
    at = Window.partitionBy(F.lit(0)).orderBy("part", key, "doc", "pos")
    edge = found.filter(F.col("kind") == EDGE).withColumn("next", F.lead(F.struct(*COLUMNS, "part")).over(at))
    across = edge.filter(f"next.part > part and next.{key} = {key} and next.doc <> doc").select(
        "doc", "pos", "whole", F.col("next.doc").alias("doc2"), F.col("next.pos").alias("pos2"), F.col("next.whole").alias("whole2"))
    return found.filter(F.col("kind") == PAIR).select("doc", "pos", "whole", "doc2", "pos2", "whole2").union(across)


def matches(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Matches of documents a < b, merged on their diagonal, as (a, b, shift, first, last): the words
    first .. last + PREFIX of a are those ``shift`` further on in b; and the suffixes (doc, pos) with a
    beginning that some suffix shares without sharing its first ``MIN_WORDS`` words."""
    first = neighbours(rows, "b1", "suffix-prefix")
    shared = first.filter(F.col("kind") == SHARED)
    second = neighbours(shared.filter("whole <> 0"), "whole", "suffix-whole", lone=True)
    lone = second.filter(F.col("kind") == LONE).select("b1").union(shared.filter("whole = 0").select("b1")).distinct()
    lone = shared.join(lone, "b1", "left_semi").select("doc", "pos")  # with all that share their beginning
    pairs = pairs_of(first, "b1").union(pairs_of(second, "whole")).select("doc", "pos", "doc2", "pos2")
    flip = F.col("doc") > F.col("doc2")
    pairs = pairs.select(F.least("doc", "doc2").alias("a"), F.greatest("doc", "doc2").alias("b"),
                         F.when(flip, F.col("pos2")).otherwise(F.col("pos")).alias("at"),
                         F.when(flip, F.col("pos") - F.col("pos2")).otherwise(F.col("pos2") - F.col("pos")).alias("shift"))
    line = Window.partitionBy("a", "b", "shift").orderBy("at")  # at most the suffixes of one document
    pairs = pairs.withColumn("gap", (F.col("at") - F.coalesce(F.lag("at").over(line), F.lit(-(10**9))) > PREFIX).cast("int"))
    pairs = pairs.withColumn("run", F.sum("gap").over(line))
    merged = pairs.groupBy("a", "b", "shift", "run").agg(F.min("at").alias("first"), F.max("at").alias("last")).drop("run")
    return merged, lone


ENDS = ("a long, b long, shift int, first int, last int, side int, inner long, left binary, right binary, "
        "starts binary, ends binary")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE to the power of 0 .. n - 1 and of 0 .. -(n - 1), modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 2**64))
    out = []
    for base in (_BASE, inverse):
        p = np.full(n, base, np.uint64)
        p[:1] = 1
        with np.errstate(over="ignore"):
            out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _ends(texts: list[bytes], wanted: pd.DataFrame) -> pd.DataFrame:
    """For each wanted match (``text``: index of its text): a hash of its words, the word hashes before
    and behind it (nearest first; 0 where the text ends), and the code points where a span begins or
    ends that is so many words longer."""
    words = Words(texts)
    lead = np.concatenate(([0], np.cumsum(words.data & 0xC0 != 0x80)))
    first = words.first[wanted["text"]]
    size = words.first[wanted["text"].to_numpy() + 1] - first
    move = np.where(wanted["side"] == 1, wanted["shift"], 0)
    low, high = wanted["first"].to_numpy() + move, wanted["last"].to_numpy() + PREFIX + move
    ok = (low >= 0) & (high <= size)  # else it belongs to another text under the same id
    wanted, first, size = wanted[ok].reset_index(drop=True), first[ok], size[ok]
    low, high = low[ok] + first, high[ok] + first
    up, down = _powers(len(words) + 1)
    short = (words.hash >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words.hash * up[:-1])))
        inner = mix((sums[high] - sums[low]) * down[low])
    reach = np.arange(REACH)[None, :]
    left, right = low[:, None] - 1 - reach, high[:, None] + reach
    in_left, in_right = left >= first[:, None], right < (first + size)[:, None]
    left, right = np.where(in_left, left, low[:, None]), np.where(in_right, right, high[:, None] - 1)
    origin = lead[words.text_at[wanted["text"]]][:, None]
    starts = (lead[words.start[np.concatenate((low[:, None], left), axis=1)]] - origin).astype(np.int64)
    ends = (lead[words.end[np.concatenate((high[:, None] - 1, right), axis=1)]] - origin).astype(np.int64)
    raw = lambda x, kind: [r.tobytes() for r in np.ascontiguousarray(x.astype(kind))]
    out = wanted[["a", "b", "shift", "first", "last", "side"]].copy()
    out["inner"] = inner.view(np.int64)
    out["left"], out["right"] = raw(np.where(in_left, short[left], 0), np.uint32), raw(np.where(in_right, short[right], 0), np.uint32)
    # offsets from the match itself fit in 32 bits
    out["starts"] = raw(np.concatenate((starts[:, :1], starts[:, :1] - starts[:, 1:]), axis=1), np.int32)
    out["ends"] = raw(np.concatenate((ends[:, :1], ends[:, 1:] - ends[:, :1]), axis=1), np.int32)
    return out


def _windows(texts: list[bytes], lone: pd.DataFrame) -> pd.DataFrame:
    """For each lone suffix (``text``, ``a``: its document, ``first``: its place) the windows of ``MIN_WORDS``
    words that begin a few words before it: ``inner`` is their hash, ``b`` their code points (first * 2**32
    + end)."""
    words = Words(texts)
    lead = np.concatenate(([0], np.cumsum(words.data & 0xC0 != 0x80)))
    back = np.arange(WINDOW_STEP, WINDOW, WINDOW_STEP)
    rows = lone.loc[lone.index.repeat(len(back))].reset_index(drop=True)
    place = rows["first"].to_numpy() - np.tile(back, len(lone))
    begin = words.first[rows["text"]] + place
    ok = (place >= 0) & (begin + MIN_WORDS <= words.first[rows["text"].to_numpy() + 1])
    rows, place, begin = rows[ok].reset_index(drop=True), place[ok], begin[ok]
    origin = lead[words.text_at[rows["text"]]]
    out = rows[["a", "b", "shift", "first", "last", "side"]].copy()
    out["first"], out["inner"] = place, _hashed(words, begin, MIN_WORDS, 300).view(np.int64)
    out["b"] = (lead[words.start[begin]] - origin) << 32 | (lead[words.end[begin + MIN_WORDS - 1]] - origin)
    for c in ("left", "right", "starts", "ends"):
        out[c] = b""
    return out


def _alike(x: pd.Series, y: pd.Series) -> np.ndarray:
    """How many words are equal from the nearest on."""
    a, b = (np.frombuffer(b"".join(c), np.uint32).reshape(len(c), REACH) for c in (x, y))
    same = np.concatenate(((a == b) & (a != 0), np.zeros((len(a), 1), bool)), axis=1)
    return same.argmin(axis=1)


def extended(docs: DataFrame, found: DataFrame, lone: DataFrame) -> DataFrame:
    """Spans of the matches of ``found`` that are long enough when extended, and of the windows before the
    ``lone`` suffixes that another document has: for each side (doc, start, end, n_words, other,
    other_start). ``docs``: (doc, text)."""
    found = materialize(found, "suffix-merged")
    alone = lone.select("doc", F.struct(F.col("doc").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).alias("shift"),
                                        F.col("pos").alias("first"), F.col("pos").alias("last"), F.lit(2).alias("side")).alias("m"))
    side = lambda doc, n: found.select(F.col(doc).alias("doc"), F.struct("a", "b", "shift", "first", "last", F.lit(n).alias("side")).alias("m"))
    # a document has at most a few matches for each of its suffixes, so its list is no longer than its text
    wanted = side("a", 0).union(side("b", 1)).union(alone).groupBy("doc").agg(F.collect_list("m").alias("wanted"))
    texts = docs.join(wanted, "doc").select("text", "wanted")
    names = ["a", "b", "shift", "first", "last", "side"]

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lists = batch["wanted"].tolist()
            for begin, run in steps(utf8(batch["text"])):
                own = lists[begin:begin + len(run)]
                flat = [[m[c] for c in names] for w in own for m in w]
                frame = pd.DataFrame(np.array(flat, np.int64).reshape(-1, len(names)), columns=names)
                frame["text"] = np.repeat(np.arange(len(run)), [len(w) for w in own])
                for k in range(0, len(frame), 20_000):
                    part = frame.iloc[k:k + 20_000]
                    yield _ends(run, part[part["side"] < 2].reset_index(drop=True))
                    yield _windows(run, part[part["side"] == 2].reset_index(drop=True))

    @F.pandas_udf("n_words long, a_start long, a_end long, b_start long, b_end long")
    def grown(n: pd.Series, al: pd.Series, ar: pd.Series, bl: pd.Series, br: pd.Series, a_s: pd.Series, a_e: pd.Series,
              b_s: pd.Series, b_e: pd.Series) -> pd.DataFrame:
        left, right = _alike(al, bl), _alike(ar, br)

        def offset(raw: pd.Series, at: np.ndarray, sign: int) -> np.ndarray:
            x = np.frombuffer(b"".join(raw), np.int32).reshape(len(raw), REACH + 1).astype(np.int64)
            return x[:, 0] + sign * np.where(at > 0, x[np.arange(len(x)), at], 0)

        return pd.DataFrame({"n_words": n + left + right, "a_start": offset(a_s, left, -1), "a_end": offset(a_e, right, 1),
                             "b_start": offset(b_s, left, -1), "b_end": offset(b_e, right, 1)})

    rows = materialize(texts.mapInPandas(ends, ENDS), "suffix-ends")
    key = ["a", "b", "shift", "first", "last", "inner"]
    sides = [rows.filter(f"side = {n}").select(*key, *[F.col(c).alias(f"{p}_{c}") for c in ("left", "right", "starts", "ends")])
             for n, p in ((0, "a"), (1, "b"))]
    both = sides[0].join(sides[1], key)
    both = both.select("a", "b", grown(F.col("last") - F.col("first") + PREFIX, "a_left", "a_right", "b_left", "b_right", "a_starts",
                                       "a_ends", "b_starts", "b_ends").alias("g")).select("a", "b", "g.*")
    both = materialize(both.filter(F.col("n_words") >= MIN_WORDS), "suffix-matches")
    one = lambda x, y: both.select(F.col(x).alias("doc"), F.col(f"{x}_start").alias("start"), F.col(f"{x}_end").alias("end"), "n_words",
                                   F.col(y).alias("other"), F.col(f"{y}_start").alias("other_start"))
    # windows before lone suffixes: their code points travel in the place of the second hash
    windows = rows.filter("side = 2").select(F.col("inner").alias("b1"), F.col("b").alias("whole"), F.col("a").alias("doc"), F.col("first").alias("pos"))
    pairs = materialize(pairs_of(neighbours(windows.distinct(), "b1", "suffix-windows"), "b1"), "suffix-window-pairs")
    span = lambda d, w, e, x: pairs.select(F.col(d).alias("doc"), F.shiftright(w, 32).alias("start"), F.col(w).bitwiseAND(F.lit(2**32 - 1)).alias("end"),
                                           F.lit(MIN_WORDS).cast("long").alias("n_words"), F.col(e).alias("other"), F.shiftright(x, 32).alias("other_start"))
    return one("a", "b").union(one("b", "a")).union(span("doc", "whole", "doc2", "whole2")).union(span("doc2", "whole2", "doc", "whole"))


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end, n_words, other_doc_id, other_start): see the module."""
    absent = -(2**62) + F.pmod(F.xxhash64(text), F.lit(2**61))  # keys of rows without an id
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), absent).alias("doc"), F.col(text).alias("text")).filter("text is not null")

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["doc"].to_numpy(np.int64)
            for first, run in steps(utf8(batch["text"])):
                yield suffixes(run, ids[first:first + len(run)])

    rows = materialize(docs.mapInPandas(kept, SUFFIX), "suffixes")
    spans = extended(docs, *matches(rows))
    at = Window.partitionBy("doc").orderBy("start", F.col("end").desc())  # the spans of one document
    until = F.max("end").over(at.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.distinct().withColumn("apart", (F.col("start") > F.coalesce(until, F.lit(-1))).cast("int"))
    spans = spans.withColumn("group", F.sum("apart").over(at))
    longest = F.max_by(F.struct("other", "other_start"), F.struct("n_words", -F.col("other"), -F.col("other_start")))
    merged = spans.groupBy("doc", "group").agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                               F.max("n_words").alias("n_words"), longest.alias("o"))
    known = lambda c: F.when(c > -(2**61), c)
    return merged.select(known(F.col("doc")).alias("doc_id"), "start", "end", "n_words",
                         known(F.col("o.other")).alias("other_doc_id"), F.col("o.other_start").alias("other_start"))
