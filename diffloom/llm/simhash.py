"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at ``radius`` (4) or fewer differing bits have a value in common that is within
half the radius (2) of both. So each distinct fingerprint stands for all 1 + 64 + 2016 = 2081
values within two bits, the values are brought together, and fingerprints that share one are
linked to the smallest of them. Any two that share a value are at most 4 bits apart, so a star
on the smallest loses no connection and no group is expanded into pairs; the distance of each
link is verified all the same.

The shuffle deals the values out by the low ``bits`` of a linear code (a syndrome over GF(2)):
the syndrome of a value is that of its fingerprint xor that of the flipped bits. A task that
receives a fingerprint for one syndrome therefore lists exactly the values of that syndrome
itself: each value is made once, in the task where it is compared, and the shuffle carries one
row for each fingerprint and syndrome, not one for each value. A task works through its values
in slices of a few more syndrome bits, so its memory is bounded.

Equal texts and equal fingerprints are collapsed before (any number of copies is one row), and
component ids are found by alternating star contractions, with each round written to the shared
checkpoint folder. Nulls and empty texts have fingerprint zero and are linked like any other.
Rows of a null id keep a fingerprint; a null id is never the smallest of a component unless it
is alone there. Repeated rows get the same component.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diffloom.llm.common import fresh, stream, utf8
from diffloom.session import materialize

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
#: A task handles the values of one syndrome of so many bits ...
BUCKET_BITS = 6
#: ... and holds at most about so many distinct fingerprints (8 bytes each): beyond, more bits.
BUCKET_ROWS = 8_000_000
#: Values that are compared at once.
SLICE_VALUES = 1 << 21


def simhash(text: bytes, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Fingerprint of one text in UTF-8: bit k is 1 if set in over half of the shingle hashes."""
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()][:n]
    stops = ends[min(shingle_words, len(words)) - 1:].tolist()
    parts = [joined[a:b] for a, b in zip(starts, stops)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(seed)), "<u8", n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        part = hashes[k: k + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of each text as a long (the unsigned value's bits)."""

    @F.pandas_udf("long")
    def fingerprints(column: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, shingle_words) for t in utf8(column)], np.uint64).view(np.int64))

    return fingerprints(text)


def hex16(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def ball(half: int) -> np.ndarray:
    """All 64-bit values with at most ``half`` bits set, the zero first."""
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    found = last = np.zeros(1, np.uint64)
    for _ in range(half):
        last = np.unique((last[:, None] | one[None, :]).ravel())
        found = np.unique(np.concatenate((found, last)))
    return found


def syndromes(values: np.ndarray, bits: int) -> np.ndarray:
    """Linear code of ``bits`` bits: bit i is the parity of the value and a fixed mask."""
    out = np.zeros(len(values), np.int64)
    for i, mask in enumerate(stream(77, bits)):
        out |= (np.bitwise_count(values & mask) & 1).astype(np.int64) << i
    return out


class Bucket:
    """Lists the values that the fingerprints of one bucket have there, slice by slice."""

    def __init__(self, half: int, bits: int):
        self.flips, self.bits = ball(half), bits

    def links(self, bucket: int, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Each fingerprint with the smallest that shares a value with it, once each."""
        expected = len(fps) * len(self.flips) / (1 << self.bits)
        more = max(0, int(np.ceil(np.log2(max(1.0, expected / SLICE_VALUES)))))
        bits = self.bits + more
        flip_code, code = syndromes(self.flips, bits), syndromes(fps, bits)
        by_code = np.argsort(flip_code, kind="stable")
        begin = np.searchsorted(flip_code[by_code], np.arange((1 << bits) + 1))
        a, b = [], []
        for high in range(1 << more):
            wanted = (high << self.bits | bucket) ^ code
            n = begin[wanted + 1] - begin[wanted]
            who = np.repeat(np.arange(len(fps)), n)
            if len(who) < 2:
                continue
            within = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
            values = fps[who] ^ self.flips[by_code[np.repeat(begin[wanted], n) + within]]
            order = np.argsort(values)
            same = np.diff(values[order]) == 0
            shared = np.concatenate((same, [False])) | np.concatenate(([False], same))
            if not shared.any():
                continue
            values, who = values[order[shared]], who[order[shared]]
            new = np.concatenate(([True], values[1:] != values[:-1]))
            # fps are sorted: the smallest index of a run is its smallest fingerprint
            lead = np.minimum.reduceat(who, np.flatnonzero(new))[np.cumsum(new) - 1]
            other = lead != who
            pair = np.unique(lead[other].astype(np.int64) << 32 | who[other])
            a.append(fps[pair >> 32])
            b.append(fps[pair & 0xFFFFFFFF])
        if not a:
            return fps[:0], fps[:0]
        a, b = np.concatenate(a), np.concatenate(b)
        near = np.bitwise_count(a ^ b) <= radius
        return a[near], b[near]


def bucket_bits(n: int) -> int:
    """``BUCKET_BITS`` while a bucket of all fingerprints fits in a task; beyond, one more for each doubling."""
    each = len(ball(RADIUS // 2))
    return BUCKET_BITS if n <= BUCKET_ROWS else int(np.ceil(np.log2(n * each / BUCKET_ROWS)))


def near_links(fps: DataFrame, radius: int = RADIUS, bits: int | None = None) -> DataFrame:
    """Links (``a`` < ``b`` as unsigned values, stored as longs) that connect all fingerprints of
    the distinct column ``fp`` as far as they are connected by steps of ``radius`` bits or fewer.
    ``radius`` is even."""
    if radius % 2:
        raise ValueError("the radius is two equal halves: give an even number")
    half = radius // 2
    bits = bucket_bits(fps.count()) if bits is None else bits
    flips = ball(half)
    offsets = np.unique(syndromes(flips, bits)).tolist()  # the same for every fingerprint: the code is linear

    @F.pandas_udf("array<int>")
    def buckets(column: pd.Series) -> pd.Series:
        own = syndromes(column.to_numpy(np.int64).view(np.uint64), bits)
        return pd.Series(list((own[:, None] ^ np.array(offsets, np.int64)[None, :]).astype(np.int32)))

    def matched(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = np.sort(rows["fp"].to_numpy(np.int64).view(np.uint64))
        a, b = Bucket(half, bits).links(int(key[0]), own, radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = fps.select(F.explode(buckets("fp")).alias("bucket"), "fp")
    return dealt.groupBy("bucket").applyInPandas(matched, "a long, b long").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each linked node reaches, by alternating star
    contractions. Each round is a few partial aggregates and joins on nodes, written to the
    shared checkpoint folder; it ends when a round changes nothing."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = materialize(edges, "star-edges")
    while True:
        # large star: neighbours above a node go to the smallest node of its neighbourhood
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        # small star: a node and its neighbours below go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        new = materialize(small, "star-edges")
        same = edges.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() == same:
            return new.select(F.col("u").alias("node"), F.col("v").alias("component"))
        edges = new


def _owned(df: DataFrame, id_col: str, text: str, radius: int, shingle_words: int) -> DataFrame:
    """(id, digest of the text, fp, component, component_id) for each row; ``component`` is the
    smallest fingerprint, ``component_id`` the smallest id."""
    prints = materialize(df.select(F.col(id_col).alias("id"), F.md5(F.coalesce(text, F.lit(""))).alias("digest"),
                                   fingerprint(F.col(text), shingle_words).alias("fp")), "simhash")
    classes = materialize(prints.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-classes")
    found = components(near_links(classes.select("fp"), radius))
    owner = (classes.join(found, classes["fp"] == found["node"], "left")
             .select("fp", "rep", F.coalesce("component", "fp").alias("component")))
    smallest = owner.groupBy("component").agg(F.min("rep").alias("component_id"))
    return prints.join(owner.select("fp", "component").join(smallest, "component"), "fp")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS,
                    shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, ``fp`` long, ``component_id``): one row for each row of ``df``."""
    found = _owned(df, id_col, text, radius, shingle_words)
    return found.select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS,
             shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each component, with its columns as they were: that of the smallest id (no id
    comes last), of several texts under this id the one of the smallest MD5, of rows equal in
    both any one."""
    found = _owned(df, id_col, text, radius, shingle_words)
    first = found.groupBy("component", "id", "digest").agg(F.count("*").alias("n"))
    first = materialize(first.groupBy("component").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "digest", "n")).alias("k")).select("k.*"), "simhash-keep")
    digest = fresh(df, "__digest")
    named = df.withColumn(digest, F.md5(F.coalesce(text, F.lit(""))))
    kept = named.join(first, named[id_col].eqNullSafe(first["id"]) & (named[digest] == first["digest"]), "left_semi")
    if not first.filter("n > 1").isEmpty():
        kept = kept.dropDuplicates([id_col, digest])
    return kept.drop(digest)
