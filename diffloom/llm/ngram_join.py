"""N-gram Jaccard join by rare-first prefix filtering.

A document's set is its distinct three-word shingles, as 64-bit hashes; equal sets are one class
(128-bit digest of the set), so copies cost one row each. Shingles are ordered rarest first, by a
table of ``1 << SKETCH_BITS`` to ``1 << MAX_SKETCH_BITS`` counters over all documents (a shingle's count is never too low), where its count is above
what other shingles put into any counter; then by the counts of its words, which stay apart however many shingles there
are; then by hash (any order is correct, the counts make it fast). Two sets that link share one of their
first ``size - ceil(0.9 size) + 1`` shingles: only these prefixes are shuffled, by shingle, and only
lists of two classes or more are kept.

To find what is connected, not every pair of a large group of near copies is needed:

1. ``ROUNDS`` times, every list is joined with ``LEADERS`` of its classes: pairs of different components are
   verified and contracted to components. A list of ``k`` classes takes ``LEADERS * k`` rows.
2. Then, in every list, all pairs of classes that are still of *different* components are candidates. Classes outside a
   list's main component are joined with the list, so a group of ``k`` copies with ``r`` others takes ``r * k`` rows.

In both, sizes are compared (length filter), shared prefix shingles are added up for each pair and bound the overlap by
what follows the last of them (positional filter), and the distance of both sets, suffixes included, is bounded from
below by the parities of their counts in two to four hash ranges a shingle: where these differ, one set has a shingle that
the other has not (suffix filter). What is left is verified, once for each pair: first each class with that of its partners which has
most pairs, then the pairs that this leaves in different components, so that a set is shuffled for a few pairs, however
large its group. In step 1 a pair may also share lists
without meeting there; the bounds add as many as either class has longer lists than leaders. A pair that is no
candidate in step 2 was verified, is in one component already or cannot link. Classes in lists go by numbers of 8 bytes. Texts are read again for the classes that are verified, whose ids are
broadcast up to ``BROADCAST_IDS`` of them and joined by a shuffle beyond; their sets are compared as arrays.

Documents without text or words have an empty set and link with nothing; documents of fewer than three
words have one shingle, all their words. Rows of a null id keep their size; a null id is
never the smallest of a component unless it is alone there. Repeated rows get the same component. An
empty table gives an empty result. Texts of any length are read whole; further columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from diffloom.llm.common import Words, steps, utf8
from diffloom.llm.simhash import components
from diffloom.operators.joins import planned_bytes
from diffloom.session import materialize

SHINGLE_WORDS = 3
#: Sets link when 100 * intersection >= PERCENT * union.
PERCENT = 90
#: The counters of words, 4 MB, and the fewest of shingles; these are doubled with the input up to ``MAX_SKETCH_BITS``, 16 MB,
#: so that what other shingles add to a counter, and with it the length of lists that are taken for rare, does not grow before.
SKETCH_BITS = 20
MAX_SKETCH_BITS = 22
#: Bytes of the table by the optimizer's estimate, for the fewest counters.
SKETCH_BYTES = 128 << 20
CHUNK = 4096
#: Classes of each list that all others of the list are paired with, and how often.
LEADERS = 8
ROUNDS = 1
#: More ids than these are joined by a shuffle (8 bytes each).
BROADCAST_IDS = 1_000_000


def weighted_sets(words: Words, cost: np.ndarray, n: int = SHINGLE_WORDS) -> list[tuple[np.ndarray, np.ndarray]]:
    """The sorted distinct shingle hashes of each text, and the sum of the costs of each one's words."""
    count = np.diff(words.first)
    total = np.concatenate(([0], np.cumsum(cost)))
    found: list[tuple[np.ndarray, ...]] = []
    for size in range(1, n + 1):
        at, h = words.windows(size)
        if size < n:  # the whole sequence of a text of so few words
            whole = count[words.text[at]] == size
            at, h = at[whole], h[whole]
        found.append((words.text[at], h, total[at + size] - total[at]))
    owner, h, weight = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((h, owner))
    owner, h, weight = owner[order], h[order], weight[order]
    new = np.ones(len(h), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    owner, h, weight = owner[new], h[new], weight[new]
    first = np.searchsorted(owner, np.arange(len(words.first)))
    return [(h[a:b], weight[a:b]) for a, b in zip(first[:-1], first[1:])]


def lower_words(texts: list[bytes]) -> Words:
    return Words([t.lower() for t in texts])  # bytes: A-Z only


def shingle_sets(texts: list[bytes], n: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = lower_words(texts)
    return [s for s, _ in weighted_sets(words, np.zeros(len(words), np.int64), n)]


def class_of(shingles: np.ndarray) -> bytes | None:
    """The 128-bit name of a set; the empty set has none."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def prefix_length(size: int, percent: int = PERCENT) -> int:
    return size - -(-percent * size // 100) + 1


def parities(shingles: np.ndarray) -> np.ndarray:
    """For each hash range, whether it has an odd number of shingles, as bits of 64-bit words. Their number is a power of
    two, two to four ranges a shingle; the two halves' exclusive or is what half as many ranges give."""
    ranges = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles % np.uint64(ranges)).astype(np.int64), minlength=ranges) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def sketch_bits(source_bytes: int) -> int:
    """How many bits number the shingles' counters for a table of so many bytes; an estimate of exabytes is none (rows of an RDD)."""
    if source_bytes >= 1 << 60:
        return SKETCH_BITS
    return min(MAX_SKETCH_BITS, SKETCH_BITS + (max(0, source_bytes - 1) // SKETCH_BYTES).bit_length())


def _slot(hashes: np.ndarray, counters: int = 1 << SKETCH_BITS) -> np.ndarray:
    """Each hash's place among ``counters``, a power of two."""
    return (hashes >> np.uint64(65 - counters.bit_length())).astype(np.int64)


def rarity(counters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each counter: a shingle's count, where it is above what other shingles put into any counter, and a word's cost."""
    of_shingles, of_words = np.split(counters.ravel(), [-(1 << SKETCH_BITS)])
    counts = np.maximum(of_shingles, int(2 * of_shingles.mean()))
    return counts, np.floor(16 * np.log2(1.0 + of_words)).astype(np.int64)


def _ordered_sets(column, counts: np.ndarray, costs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each text's set, sorted by hash and rarest first."""
    for _, run in steps(utf8(column)):
        words = lower_words(run)
        for shingles, weight in weighted_sets(words, costs[_slot(words.hash, len(costs))]):
            yield shingles, rare_first(shingles, counts, weight)


def _classes_and_counts(batches: Iterator[pd.DataFrame], bits: int = SKETCH_BITS) -> Iterator[pd.DataFrame]:
    """(kind 0: id, class, size of each row; kind 1: this task's counters, chunk by chunk)."""
    counters = np.zeros((1 << bits) + (1 << SKETCH_BITS), np.uint32)
    of_shingles, of_words = np.split(counters, [1 << bits])
    for batch in batches:
        sets = []
        for _, run in steps(utf8(batch["text"])):
            words = lower_words(run)
            found = [s for s, _ in weighted_sets(words, np.zeros(len(words), np.int64))]
            for table, hashes in ((of_shingles, np.concatenate(found)), (of_words, words.hash)):
                np.add.at(table, _slot(hashes, len(table)), np.uint32(1))
            sets += found
        yield pd.DataFrame({"kind": 0, "id": batch["id"], "cls": [class_of(s) for s in sets], "size": [len(s) for s in sets],
                            "chunk": 0, "counts": None})
    parts = counters.reshape(-1, CHUNK)
    for k in np.flatnonzero(parts.any(axis=1)).tolist():
        yield pd.DataFrame({"kind": [1], "id": [None], "cls": [None], "size": [0], "chunk": [k], "counts": [packed(parts[k])]})


def _added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sum of each chunk's counters, from rows sorted by chunk; one chunk in memory."""
    now, total = None, None
    for batch in batches:
        for chunk, counts in zip(batch["chunk"].tolist(), batch["counts"]):
            if chunk != now:
                if total is not None:
                    yield pd.DataFrame({"chunk": [now], "counts": [packed(total)]})
                now, total = chunk, np.zeros(CHUNK, np.int64)
            total += unpacked(counts)
    if total is not None:
        yield pd.DataFrame({"chunk": [now], "counts": [packed(total)]})


def packed(counts: np.ndarray) -> bytes:
    """Counts, clipped to 32 bits, in the fewest bytes a number that hold the largest, compressed: a task's counters are as many
    for every task, and most of them are zero or small."""
    counts = np.minimum(counts, (1 << 32) - 1)
    width = np.min_scalar_type(counts.max(initial=0)).itemsize
    return bytes([width]) + zlib.compress(counts.astype(f"u{width}").tobytes(), 1)


def unpacked(counts: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(counts[1:]), f"u{counts[0]}").astype(np.uint32)


def rare_first(shingles: np.ndarray, counts: np.ndarray, weight: np.ndarray | int = 0) -> np.ndarray:
    """Shingles sorted by hash in order of count, then of the weight of their words (below 2^11), then of hash."""
    count = counts[_slot(shingles, len(counts))].astype(np.int64)
    return shingles[np.argsort((count << 11) + weight, kind="stable")]


def _prefixes(rows: DataFrame, counters, percent: int) -> DataFrame:
    """(token, cls, size, pos) of the prefixes; a task lists each class once."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        seen, tables = set(), rarity(counters.value)
        for batch in batches:
            tokens, names, sizes, lengths = [], [], [], []
            for s, rarest in _ordered_sets(batch.column(0).to_pylist(), *tables):
                name = class_of(s)
                if name is None or name in seen:
                    continue
                seen.add(name)
                n = prefix_length(len(s), percent)
                tokens.append(rarest[:n].view(np.int64))
                names.append(name)
                sizes.append(len(s))
                lengths.append(n)
            if tokens:
                at = pa.array(np.repeat(np.arange(len(names)), lengths))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens)), pa.array(names, pa.binary()).take(at),
                     pa.array(np.repeat(sizes, lengths).astype(np.int32)),
                     pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in lengths]))],
                    names=["token", "cls", "size", "pos"])

    return rows.select("text").mapInArrow(listed, "token long, cls binary, size int, pos int")


def _sets(rows: DataFrame) -> DataFrame:
    """(cls, tokens, odd): the sets of those texts that have the class ``name`` beside them, and their parities."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = (s for _, run in steps(utf8(batch["text"])) for s in shingle_sets(run))
            # a repeated id may have another text
            found = [(number, s) for number, name, s in zip(batch["cls"], batch["name"], sets) if class_of(s) == name]
            yield pd.DataFrame({"cls": [number for number, _ in found], "tokens": [s.view(np.int64) for _, s in found],
                                "odd": [parities(s) for _, s in found]})

    return rows.select("text", "cls", "name").mapInPandas(made, "cls long, tokens array<long>, odd array<long>")


def _fits(a: str, b: str, percent: int) -> Column:
    """Length filter: the smaller set is at least ``percent`` of the larger one."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _needed(percent: int, a: str = "a_size", b: str = "b_size") -> Column:
    """The least intersection of two linked sets of these sizes."""
    return F.ceil(percent * (F.col(a) + F.col(b)) / (100 + percent))


def _in_reach(percent: int) -> Column:
    """Positional filter where two rows meet: no more is shared before the shingle than either has in the lists before
    it, and no more from it on than either has left. (A shingle shared before it is in both prefixes, so in a list; one
    behind it need not be.) A pair that fails at one shingle cannot link."""
    before = F.least("x_rank", "y_rank")
    left = F.least(F.col("x_size") - F.col("x_pos"), F.col("y_size") - F.col("y_pos"))
    return before + left >= _needed(percent, "x_size", "y_size")


def _fetch(pairs: DataFrame, rows: DataFrame, classes: DataFrame, known: DataFrame | None) -> DataFrame:
    """(cls, tokens, odd) of the classes in ``pairs``, those of ``known`` among them: texts are found by the classes' smallest ids."""
    wanted = _classes_in(pairs)
    if known is not None:
        wanted = wanted.join(known.select("cls"), "cls", "left_anti")
    wanted = materialize(classes.join(wanted, "cls", "left_semi").select("cls", "name", "rep"), "ngram-wanted")
    n = wanted.count()
    texts = rows.join(F.broadcast(wanted) if n <= BROADCAST_IDS else wanted, F.col("id").eqNullSafe(F.col("rep")))
    found = materialize(_sets(texts), "ngram-sets")
    if found.count() > n:  # repeated rows of one id
        found = materialize(found.dropDuplicates(["cls"]), "ngram-sets")
    return found if known is None else known.union(found)


def _classes_in(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()


def _only(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The sets of the classes in ``pairs``: the others are not shuffled to the pairs."""
    names = materialize(_classes_in(pairs), "ngram-names")
    return sets.join(F.broadcast(names) if names.count() <= BROADCAST_IDS else names, "cls", "left_semi")


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that the suffix filter leaves. A set with twice the other's ranges is folded; none has more where
    ``percent`` is above 50, and below that such pairs stay."""
    odd = _only(sets.select("cls", "odd"), pairs)
    pairs = (pairs.join(odd.select(F.col("cls").alias("a"), F.col("odd").alias("a_odd")), "a")
             .join(odd.select(F.col("cls").alias("b"), F.col("odd").alias("b_odd")), "b"))

    def folded(own: str, other: str) -> Column:
        n = F.size(other)
        halves = F.zip_with(F.slice(own, F.lit(1), n), F.slice(own, n + 1, n), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(own) > n, halves).otherwise(F.col(own))

    unlike = F.aggregate(F.zip_with(folded("a_odd", "b_odd"), folded("b_odd", "a_odd"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                         F.lit(0), lambda x, y: x + y)
    more = F.greatest(F.size("a_odd"), F.size("b_odd")) > 2 * F.least(F.size("a_odd"), F.size("b_odd"))
    pairs = pairs.filter(more | (F.col("a_size") + F.col("b_size") - unlike >= 2 * _needed(percent)))
    return materialize(pairs.select("a", "b", "a_size", "b_size"), "ngram-possible")


def _to_hubs(pairs: DataFrame) -> DataFrame:
    """Each class's pair with that of its partners which has most pairs (ties: the largest): no more pairs than classes."""
    ends = pairs.select(F.col("a").alias("x"), F.col("b").alias("y")).union(pairs.select("b", "a"))
    degree = ends.groupBy("x").agg(F.count("*").alias("n")).select(F.col("x").alias("y"), "n")
    hubs = ends.join(degree, "y").groupBy("x").agg(F.max_by("y", F.struct("n", "y")).alias("y"))
    return pairs.join(hubs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")), ["a", "b"], "left_semi")


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) of pairs, by their sets."""
    pairs = materialize(pairs, "ngram-verify")
    sets = _only(sets.select("cls", "tokens"), pairs)
    both = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("a_tokens")), "a")
            .join(sets.select(F.col("cls").alias("b"), F.col("tokens").alias("b_tokens")), "b"))
    same = F.size(F.array_intersect("a_tokens", "b_tokens"))
    both = both.select("a", "b", "a_size", "b_size", same.alias("same")).select(
        "a", "b", (100 * F.col("same") >= percent * (F.col("a_size") + F.col("b_size") - F.col("same"))).alias("linked"))
    return materialize(both, "ngram-checked")


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs of classes that are in different components."""
    for end in ("a", "b"):
        pairs = pairs.join(comps.select(F.col("node").alias(end), F.col("component").alias(f"{end}_comp")), end, "left")
    other = F.coalesce("a_comp", "a") != F.coalesce("b_comp", "b")
    return pairs.filter(other).select("a", "b", "a_size", "b_size")


def _numbered(lists: DataFrame) -> DataFrame:
    """Lists whose classes (``name``) have numbers: that of one of their rows in the written table; one shuffle, by class."""
    of_class = Window.partitionBy("name")
    lists = lists.withColumn("row", F.monotonically_increasing_id()).withColumn("cls", F.min("row").over(of_class))
    long = F.sum((F.col("k") > LEADERS).cast("int")).over(of_class).cast("int")
    return materialize(_ranked(lists.withColumn("long", long), "name").drop("row", "k"), "ngram-numbered")


def _across(lists: DataFrame, comps: DataFrame) -> DataFrame:
    """The lists with classes of more than one component; ``main`` is the one most of a list belong to."""
    owned = lists.join(comps, lists["cls"] == comps["node"], "left").select(
        "token", "cls", "size", "pos", "long", F.coalesce("component", "cls").alias("comp"))
    in_list = Window.partitionBy("token")
    owned = (owned.withColumn("main", F.mode("comp").over(in_list)).withColumn("low", F.min("comp").over(in_list))
             .withColumn("high", F.max("comp").over(in_list)).filter("low <> high").drop("low", "high"))
    return materialize(_ranked(owned, "cls"), "ngram-across")


def _ranked(lists: DataFrame, by: str) -> DataFrame:
    """With how many rows a class has in these lists, and how many of them come before; a class has no more than its prefix."""
    of_class = Window.partitionBy(by)
    return lists.withColumn("known", F.count("*").over(of_class)).withColumn("rank", F.row_number().over(of_class.orderBy("pos")) - 1)


def _side(lists: DataFrame, p: str, *more: str) -> DataFrame:
    return lists.select("token", *more, *[F.col(c).alias(f"{p}_{c}") for c in ("cls", "size", "pos", "comp", "long", "known", "rank")])


def _with_leaders(lists: DataFrame, seed: int, percent: int) -> DataFrame:
    """The rows of each list beside its leaders of other components; two leaders meet once. Leaders are, at first, the
    classes with the largest share of their set in lists (those most like others), later any by hash."""
    central = [(F.col("known") / F.col("size")).desc()] if seed == 0 else []
    order = Window.partitionBy("token").orderBy(*central, F.xxhash64("cls", F.lit(seed)), "cls")
    ranked = lists.withColumn("k", F.row_number().over(order))
    met = _side(ranked.filter(F.col("k") <= LEADERS), "x").join(_side(ranked, "y", "k"), "token")
    met = met.filter((F.col("x_comp") != F.col("y_comp")) & _fits("x_size", "y_size", percent) & _in_reach(percent)
                     & ((F.col("k") > LEADERS) | (F.col("x_cls") < F.col("y_cls"))))
    # a pair may share lists in which neither is a leader: no more than either has long ones
    return _pairs(met.withColumn("unseen", F.least("x_long", "y_long")), percent)


def _with_all(lists: DataFrame, percent: int) -> DataFrame:
    """The rows outside a list's main component beside all of other components, each pair of rows once."""
    x, y = _side(lists.filter("comp <> main"), "x"), _side(lists, "y", "main")
    met = x.join(y, "token").filter((F.col("x_comp") != F.col("y_comp")) & _fits("x_size", "y_size", percent) & _in_reach(percent)
                                    & ((F.col("y_comp") == F.col("main")) | (F.col("x_cls") < F.col("y_cls"))))
    return _pairs(met.withColumn("unseen", F.lit(0)), percent)


def _pairs(met: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs by the positional filter: the prefix shingles they share (``unseen`` lists counted as shared) and
    what is left of the sets behind the last are enough."""
    swap = F.col("x_cls") > F.col("y_cls")
    pick = lambda c, one, other: F.when(swap, F.col(f"{other}_{c}")).otherwise(F.col(f"{one}_{c}"))
    met = met.select(pick("cls", "x", "y").alias("a"), pick("cls", "y", "x").alias("b"), pick("size", "x", "y").alias("a_size"),
                     pick("size", "y", "x").alias("b_size"), pick("pos", "x", "y").alias("a_pos"), pick("pos", "y", "x").alias("b_pos"), "unseen")
    pairs = met.groupBy("a", "b", "a_size", "b_size").agg((F.count("*") + F.max("unseen")).alias("shared"), F.max("a_pos").alias("a_pos"), F.max("b_pos").alias("b_pos"))
    behind = F.least(F.col("a_size") - F.col("a_pos"), F.col("b_size") - F.col("b_pos")) - 1
    return pairs.filter(F.col("shared") + behind >= _needed(percent)).select("a", "b", "a_size", "b_size")


def _counters(spark: SparkSession, counted: DataFrame, bits: int = SKETCH_BITS):
    """The summed counters, as a broadcast array: ``1 << bits`` numbers of shingles, ``1 << SKETCH_BITS`` of words."""
    sums = (counted.filter("kind = 1").select("chunk", "counts").repartition("chunk").sortWithinPartitions("chunk")
            .mapInPandas(_added, "chunk int, counts binary"))
    table = np.zeros((1 << bits) + (1 << SKETCH_BITS), np.uint32).reshape(-1, CHUNK)
    for row in sums.collect():  # a row for each chunk
        table[row.chunk] = unpacked(row.counts)
    return spark.sparkContext.broadcast(table.ravel())


def links(df: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(id, cls, size) for each row, and (a, b) links between classes that connect all that links connect."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    bits = sketch_bits(planned_bytes(df))
    counted = materialize(rows.mapInPandas(lambda batches: _classes_and_counts(batches, bits), "kind int, id long, cls binary, size int, chunk int, counts binary"), "ngram-classes")
    members = counted.filter("kind = 0").select("id", "cls", "size")
    classes = members.filter("cls is not null").groupBy("cls").agg(F.min("id").alias("rep"))
    counters = _counters(spark, counted, bits)
    in_list = Window.partitionBy("token")
    lists = _prefixes(rows, counters, percent).repartition("token").groupBy("token", F.col("cls").alias("name")).agg(
        F.min("size").alias("size"), F.min("pos").alias("pos"))
    lists = _numbered(materialize(lists.withColumn("k", F.count("*").over(in_list)).filter("k > 1"), "ngram-lists"))
    named = lists.filter("rank = 0").select("cls", "name")  # one row of each class
    classes = materialize(named.join(classes.withColumnRenamed("cls", "name"), "name"), "ngram-named")
    checked = linked = comps = sets = None
    for step in range(ROUNDS + 1):
        across = lists.withColumn("comp", F.col("cls")) if comps is None else _across(lists, comps)
        pairs = _with_leaders(across, step, percent) if step < ROUNDS else _with_all(across, percent)
        if checked is not None:
            pairs = pairs.join(checked.select("a", "b"), ["a", "b"], "left_anti")
        pairs = materialize(pairs, "ngram-pairs")
        sets = _fetch(pairs, rows, classes, sets)
        pairs = _possible(pairs, sets, percent)
        for chosen in (_to_hubs(pairs), None):
            if chosen is None:
                comps = components(linked)
                chosen = _apart(pairs.join(found.select("a", "b"), ["a", "b"], "left_anti"), comps)
            found = _compared(chosen, sets, percent)
            checked = found if checked is None else checked.union(found)
            new = found.filter("linked").select("a", "b")
            linked = new if linked is None else linked.union(new)
        if step < ROUNDS:
            comps = components(linked)
    for end in ("a", "b"):
        linked = linked.join(classes.select(F.col("cls").alias(end), F.col("name").alias(f"{end}_name")), end)
    return members, linked.select(F.col("a_name").alias("a"), F.col("b_name").alias("b"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id): one row for each row of ``df``."""
    members, linked = links(df, id_col, text, percent)
    found = components(linked)
    classes = members.filter("cls is not null").groupBy("cls").agg(F.min("id").alias("rep"))
    owner = classes.join(found, classes["cls"] == found["node"], "left").select("cls", "rep", F.coalesce("component", "cls").alias("component"))
    smallest = owner.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = owner.select("cls", "component").join(smallest, "component").select("cls", "component_id")
    return members.join(named, "cls", "left").select(
        F.col("id").alias(id_col), F.col("size").cast("long").alias("n_shingles"),
        F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
