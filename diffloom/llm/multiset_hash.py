"""Order-independent document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph is a line (``\\n``). Each is hashed to a wide vector, and a text's fingerprint is the
sum of its paragraphs' vectors, lane by lane modulo powers of two:

* 16 lanes modulo 2**64 from a 1024-bit digest of the paragraph: equal multisets of paragraphs
  have equal sums, whatever their order, and different ones differ but for a hash collision;
* 128 lanes modulo 2**32 in which each three-word shingle of the paragraph adds or takes away
  one: the cosine of two such sums estimates how much the texts share.

As sums, fingerprints can be kept up to date: add the vector of an inserted paragraph, subtract
that of a deleted one (``combine``), or add up the fingerprints of parts.

Nulls and empty texts are the text of one empty paragraph. Rows of any text length are processed
whole; equal texts have equal fingerprints. A table is paired with its neighbours in id order
without a global sort in one task: see ``edited``.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diffloom.llm.common import Words, steps, utf8

EXACT_LANES = 16
LIKENESS_LANES = 128
SHINGLE_WORDS = 3
_EXACT_BYTES = 8 * EXACT_LANES
#: A longer text is hashed in parts of about so many bytes, cut between paragraphs.
PART_BYTES = 1 << 18


def _parts(text: bytes) -> Iterator[bytes]:
    """The text cut at line breaks into parts of about ``PART_BYTES``; a longer line stays whole."""
    start = 0
    while (end := text.find(b"\n", start + PART_BYTES)) >= 0:
        yield text[start:end]
        start = end + 1
    yield text[start:]


def vectors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(texts x 16 lanes modulo 2**64, texts x 128 lanes modulo 2**32). A long text is the sum of its
    parts, one in memory at a time."""
    exact = np.zeros((len(texts), EXACT_LANES), np.uint64)
    likeness = np.zeros((len(texts), LIKENESS_LANES), np.uint32)
    short = [i for i, t in enumerate(texts) if len(t) <= PART_BYTES]
    exact[short], likeness[short] = _part_vectors([texts[i] for i in short])
    for i, text in enumerate(texts):
        if len(text) > PART_BYTES:
            for part in _parts(text):
                a, b = _part_vectors([part])
                exact[i] += a[0]
                likeness[i] += b[0]
    return exact, likeness


def _part_vectors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    n = len(texts)
    exact = np.zeros((n, EXACT_LANES), np.uint64)
    for i, text in enumerate(texts):
        lines = Counter(text.split(b"\n"))
        digests = b"".join(hashlib.shake_128(line).digest(_EXACT_BYTES) for line in lines)
        times = np.fromiter(lines.values(), np.uint64, len(lines))[:, None]
        exact[i] = (np.frombuffer(digests, "<u8").reshape(-1, EXACT_LANES) * times).sum(axis=0, dtype=np.uint64)
    likeness = np.zeros((n, LIKENESS_LANES), np.int64)
    words = Words(texts)
    if len(words):
        breaks = np.flatnonzero(words.data == 10)
        line = np.searchsorted(breaks, words.start)
        size = np.bincount(line)
        for length in range(1, SHINGLE_WORDS + 1):  # a line of fewer words is one shingle
            at, h = words.windows(length, group=line)
            if length < SHINGLE_WORDS:
                whole = size[line[at]] == length
                at, h = at[whole], h[whole]
            lane = words.text[at] * LIKENESS_LANES + (h & np.uint64(LIKENESS_LANES - 1)).astype(np.int64)
            sign = 1 - 2 * ((h >> np.uint64(32)) & np.uint64(1)).astype(np.int64)
            likeness += np.bincount(lane, sign, n * LIKENESS_LANES).astype(np.int64).reshape(n, -1)
    return exact, likeness.astype(np.uint32)


def to_hex(exact: np.ndarray, likeness: np.ndarray) -> list[str]:
    return [a.astype("<u8").tobytes().hex() + b.astype("<u4").tobytes().hex() for a, b in zip(exact, likeness)]


def from_hex(prints) -> tuple[np.ndarray, np.ndarray]:
    raw = [bytes.fromhex(p) for p in prints]
    exact = np.array([np.frombuffer(r[:_EXACT_BYTES], "<u8") for r in raw], np.uint64).reshape(-1, EXACT_LANES)
    likeness = np.array([np.frombuffer(r[_EXACT_BYTES:], "<u4") for r in raw], np.uint32).reshape(-1, LIKENESS_LANES)
    return exact, likeness


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 to 1, pair by pair: 1 for equal sums, else the cosine of the likeness lanes, at least 0."""
    x, y = a[1].view(np.int32).astype(float), b[1].view(np.int32).astype(float)
    size = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    cosine = np.divide((x * y).sum(1), size, out=np.zeros(len(x)), where=size > 0)
    equal = (a[0] == b[0]).all(1) & (a[1] == b[1]).all(1)
    return np.where(equal, 1.0, np.clip(cosine, 0.0, 1.0))


def fingerprint(text: Column) -> Column:
    """The fingerprint of each text, in hex."""

    @F.pandas_udf("string")
    def fingerprints(column: pd.Series) -> pd.Series:
        return pd.Series([p for _, run in steps(utf8(column)) for p in to_hex(*vectors(run))], dtype=object)

    return fingerprints(text)


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of the paragraphs of ``a`` with those of ``b`` inserted (sign 1) or deleted
    (sign -1), from the fingerprints alone. Null if either is null."""

    @F.pandas_udf("string")
    def combined(x: pd.Series, y: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(x), dtype=object)
        both = (x.notna() & y.notna()).to_numpy()
        if both.any():
            p, q = from_hex(x[both]), from_hex(y[both])
            if sign > 0:
                out[both] = to_hex(p[0] + q[0], p[1] + q[1])
            else:
                out[both] = to_hex(p[0] - q[0], p[1] - q[1])
        return out

    return combined(a, b)


LAST = -(2**63)  # the order key of rows without an id: they come last


def with_guests(df: DataFrame, id_col: str, text: str, ranges: int) -> DataFrame:
    """Rows (``range``, ``guest``, ``key``, id, text) such that, inside a range, each row that is
    no guest is followed, by descending key, by its next document: the ranges' borders, found
    from the ids alone, are few, and the first row of each range is also a guest of the range
    above it (that of the highest is a guest of the lowest)."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"),
                     F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("key"))
    shares = [k / ranges for k in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("key", shares, max(10_000, 20 * ranges))).first()[0] if shares else []
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(np.int64)).astype(np.int32))

    # one row for each range: at most as many as there are cuts, and one
    tops = rows.groupBy(range_of("key").alias("range")).agg(F.max("key").alias("top")).orderBy("range").collect()
    hosts = {r.top: tops[(k + 1) % len(tops)].range for k, r in enumerate(tops)}

    @F.pandas_udf("array<int>")
    def places(key: pd.Series) -> pd.Series:
        own = np.searchsorted(cuts, key.to_numpy(np.int64)).tolist()
        return pd.Series([[o, hosts[k]] if k in hosts else [o] for o, k in zip(own, key.tolist())], dtype=object)

    placed = rows.select(F.posexplode(places("key")).alias("guest", "range"), "id", "text", "key")
    return placed.select("range", "guest", "key", "id", "text")


def edited(df: DataFrame, id_col: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Each text with its edited text (the last third of its code points replaced by the first as
    many of the next document by descending id; after the last comes the first).

    Texts are shuffled once, by range of id; a task streams through its sorted rows with one row
    held back. Rows of one id are in the order of their texts, nulls first; rows without an id
    come last. Where several rows share the id that begins a range, the first of them is next.
    A table of one row is its own next. An empty table gives an empty result.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (with_guests(df, id_col, text, ranges or 2 * parts).repartition(parts, "range")
             .sortWithinPartitions("range", "guest", F.col("key").desc(), "text"))

    def stream_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # (range, id, text, fingerprints) of the row that waits for its next
        for batch in batches:
            ranges_, guests = batch["range"].tolist(), batch["guest"].tolist()
            ids = [None if pd.isna(i) else int(i) for i in batch["id"]]
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for first, run in steps(utf8(texts)):
                prints = vectors(run)
                pairs = []
                for k in range(len(run)):
                    j = first + k
                    own = (prints[0][k], prints[1][k])
                    if held is not None and held[0] == ranges_[j]:
                        pairs.append((held[1:], (ids[j], texts[j], own)))
                        held = None
                    if not guests[j]:
                        held = (ranges_[j], ids[j], texts[j], own)
                if pairs:
                    yield _edit(pairs)

    return dealt.mapInPandas(stream_rows, SCHEMA)


SCHEMA = ("id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _edit(pairs: list[tuple]) -> pd.DataFrame:
    new = []
    for (_, a, _), (_, b, _) in pairs:
        k = len(a) // 3
        new.append(a[: len(a) - k] + b[:k])
    own = tuple(np.array([p[0][2][i] for p in pairs]) for i in (0, 1))
    following = tuple(np.array([p[1][2][i] for p in pairs]) for i in (0, 1))
    changed = [vectors(run) for _, run in steps(utf8(new))]
    changed = tuple(np.concatenate([c[i] for c in changed]) for i in (0, 1))
    return pd.DataFrame({
        "id": pd.array([p[0][0] for p in pairs], "Int64"), "n_chars": [len(p[0][1]) for p in pairs],
        "edited_text": new, "fingerprint": to_hex(*own), "edited_fingerprint": to_hex(*changed),
        "near_edited": likeness(own, changed), "near_next": likeness(own, following)})
