"""Spelling variants by a variable-length gram index.

*Dictionary.* The grams of two and more characters are counted over all words. A gram found often
(``frequent``) is too common to tell words apart and is extended; the others end. The threshold is
``LIST`` or, for large vocabularies, the number of grams over ``NODES``: so the dictionary of
frequent grams, which is broadcast, has at most ``NODES`` entries for each length.

*Decomposition.* From each position of a word the gram is extended while it is frequent, to
``longest`` characters at most; grams that lie inside an earlier one are left out. Where a gram
ends depends on its own characters alone, so an edit changes only grams that contain its
place, and grams right behind it that a changed gram may now swallow (possible only if what lies
between is the end of a frequent gram). ``affected`` takes the worst place for each word: a near
word shares all grams but so many, at the same distance from the start or from the end.

*List merging.* A word that shares at least ``b`` of its ``g`` grams with any near word shares one
of its ``g - b + 1`` rarest with it, so only these lists are kept for it and joined by (gram, place).
Where a short word has ``b = 0``, all its grams are kept; two such words are compared again with a
dictionary of shorter grams. With ``longest`` 3 every word of 7 characters has ``b >= 1``, so no
pair is lost. Pairs are verified where they meet, by a bitmap of neighbouring characters that all near words
pass and then by their edit distance, and counted once.

Only distinct words are joined. Links from words to their forms are followed by pointer doubling in
rounds that are written to the shared checkpoint folder; a form is at least ``TIMES`` times as
frequent as the word, so chains are short. Nulls and empty texts have no words; a null id is written
as the empty text in the hash of ``typo``; an empty table has no words; repeated rows count again;
texts of any length are read whole; further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diffloom.session import materialize

MIN_LENGTH = 7
MIN_COUNT = 2
TIMES = 10
SHORTEST = 2
#: Longest grams of the dictionaries, tried in this order.
LONGEST = (5, 4, 3)
#: A gram of more places than this is extended ...
LIST = 32
#: ... or of more than (all places / NODES), whichever is larger.
NODES = 50_000
#: Entries that a task counts before it hands them on.
HELD = 200_000

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def typo(doc_id, run: str) -> str:
    """The stand-in misspelling of the query: a code point less where 31 divides the hash."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode("utf-8", "surrogatepass"))
    return run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1:]


def _counted(batches: Iterator[pd.DataFrame], items: Callable[[pd.DataFrame], Iterator[tuple[str, int]]], name: str) -> Iterator[pd.DataFrame]:
    """Sums of the items' numbers, handed on before they outgrow a task."""
    held: Counter = Counter()
    for batch in batches:
        for item, n in items(batch):
            held[item] += n
            if len(held) >= HELD:
                yield pd.DataFrame({name: list(held), "n": list(held.values())})
                held = Counter()
    if held:
        yield pd.DataFrame({name: list(held), "n": list(held.values())})


def word_counts(df: DataFrame, id_col: str = "doc_id", text: str = "text", change: Callable[[object, str], str] | None = None,
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): runs of letters, lower-cased (A-Z) and changed by ``change(id, run)``, that have
    ``min_length`` code points after it and occur ``min_count`` times in all texts."""
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{min_length},}}")  # a change makes no run longer

    def words(batch: pd.DataFrame) -> Iterator[tuple[str, int]]:
        for doc, body in zip(batch["id"], batch["text"]):
            found = Counter()
            for run, n in Counter(runs.findall(body or "")).items():
                found[run.translate(_LOWER)] += n
            for run, n in found.items():
                word = change(doc, run) if change else run
                if len(word) >= min_length:
                    yield word, n

    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(text).alias("text"))
    counts = rows.mapInPandas(lambda batches: _counted(batches, words, "word"), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def frequent_grams(words: DataFrame, longest: int = LONGEST[0], least: int = LIST, nodes: int = NODES) -> dict[str, int]:
    """The grams to be extended, with their numbers of places: at most ``nodes`` for each length."""

    def grams(batch: pd.DataFrame) -> Iterator[tuple[str, int]]:
        for word in batch["word"]:
            for size in range(SHORTEST, longest):
                for p in range(len(word) - size + 1):
                    yield word[p:p + size], 1

    counts = materialize(words.select("word").mapInPandas(lambda batches: _counted(batches, grams, "gram"), "gram string, n long")
                         .groupBy("gram").agg(F.sum("n").alias("n")), "spelling-grams")
    places = counts.filter(F.length("gram") == SHORTEST).agg(F.sum("n")).first()[0] or 0
    found = counts.filter(F.col("n") > max(least, places // nodes)).collect()  # bounded by nodes for each length
    return {r.gram: r.n for r in found}


def decompose(word: str, frequent, longest: int) -> list[tuple[int, int]]:
    """(start, end) of the word's variable grams."""
    out, reach, size = [], 0, len(word)
    for p in range(size - SHORTEST + 1):
        e = p + SHORTEST
        while e < size and e - p < longest and word[p:e] in frequent:
            e += 1
        if e > reach:
            out.append((p, e))
            reach = e
    return out


def affected(word: str, grams: list[tuple[int, int]], frequent, endings: set[str], longest: int) -> int:
    """The largest number of the word's grams that one edit can take away."""
    size = len(word)
    changed, inserted = [0] * size, [0] * (size + 1)  # grams lost to an edit of character i, to one inserted before i
    for p, e in grams:
        for i in range(p, e):
            changed[i] += 1
        for i in range(max(0, e - longest), p):
            changed[i] += word[i + 1:e - 1] in endings
        for i in range(p + 1, e):
            inserted[i] += 1
        for i in range(max(0, e - longest + 1), p + 1):
            inserted[i] += word[i:e - 1] in endings
        if e == size and e - p < longest and word[p:e] in frequent:  # ended by the word: more characters extend it
            inserted[size] += 1
    return max(max(changed), max(inserted))


def kept_grams(word: str, frequent: dict[str, int], endings: set[str], longest: int) -> tuple[list[tuple[int, int]], int]:
    """The word's rarest grams, as many as its bound asks for (and all equal to the last), and the bound."""
    grams = decompose(word, frequent, longest)
    bound = len(grams) - affected(word, grams, frequent, endings, longest)

    def rarity(span):  # from the dictionary alone, so that it is the same for all words
        gram = word[span[0]:span[1]]
        about = frequent.get(gram) or min(frequent.get(gram[:-1], 1), frequent.get(gram[1:], 1))
        return about, gram

    grams.sort(key=rarity)
    n = len(grams) - max(bound, 1) + 1
    last = rarity(grams[n - 1])
    return [g for g in grams if rarity(g) <= last], bound


def bigram_bits(word: str) -> int:
    """A bit for each pair of neighbours, by hash, as a signed long. An edit takes two pairs away at most
    and adds two, so near words differ in four bits at most."""
    bits = 0
    for x, y in zip(word, word[1:]):
        bits |= 1 << ((ord(x) * 0x9E3779B1 ^ ord(y) * 0x85EBCA6B) >> 7 & 63)
    return bits - (1 << 64) if bits >> 63 else bits


POSTINGS = "gram string, side string, place int, word string, size int, bits long, n long, short boolean"


def postings(words: DataFrame, frequent: dict[str, int], longest: int) -> DataFrame:
    """The lists of a dictionary: a word's kept grams by their distance from its start and end. ``short``
    marks words without a bound."""
    spark = words.sparkSession
    own = {g: n for g, n in frequent.items() if len(g) < longest}
    shared = spark.sparkContext.broadcast((own, {g[k:] for g in own for k in range(1, len(g))}))

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, endings = shared.value
        for batch in batches:
            rows = []
            for word, n in zip(batch["word"].tolist(), batch["n"].tolist()):
                grams, bound = kept_grams(word, known, endings, longest)
                own = (word, len(word), bigram_bits(word), n, bound < 1)
                for p, e in grams:
                    rows.append((word[p:e], "start", p, *own))
                    rows.append((word[p:e], "end", len(word) - p, *own))
            yield pd.DataFrame(rows, columns=["gram", "side", "place", "word", "size", "bits", "n", "short"])

    return words.select("word", "n").mapInPandas(listed, POSTINGS)


def near_pairs(words: DataFrame, longest: tuple[int, ...] = LONGEST, least: int = LIST, nodes: int = NODES) -> DataFrame:
    """(a, a_n, b, b_n), each pair of near words once, of (word, n) with distinct words of ``MIN_LENGTH`` or more."""
    frequent = frequent_grams(words, longest[0], least, nodes)
    found, left = None, words
    for k, q in enumerate(longest):
        # a list goes by its hash: pairs that meet by a collision are verified like the others
        lists = materialize(postings(left, frequent, q).select(
            F.xxhash64("gram", "side", "place").alias("list"), (F.col("side") == "start").alias("start"), "word", "size", "bits", "n", "short"), "spelling-lists")
        columns = ("start", "word", "size", "bits", "n")  # the same on both sides: one shuffle serves them
        a, b = (lists.select("list", *[F.col(c).alias(f"{end}_{c}") for c in columns]) for end in "ab")
        near = (a.join(b, "list")
                .filter((F.bit_count(F.col("a_bits").bitwiseXOR(F.col("b_bits"))) <= 4) & (F.abs(F.col("a_size") - F.col("b_size")) <= 1)
                        & ((F.col("a_start") & F.col("b_start")) | (F.col("a_size") != F.col("b_size")))
                        & (F.col("a_word") < F.col("b_word")) & (F.levenshtein("a_word", "b_word", 1) == 1))
                .select(F.col("a_word").alias("a"), F.col("a_n"), F.col("b_word").alias("b"), F.col("b_n")))
        found = near if found is None else found.union(near)
        left = lists.filter("short").select("word", "n").distinct()
        if k + 1 < len(longest):
            left = materialize(left, "spelling-short")
    return found.distinct()


def variants(words: DataFrame, times: int = TIMES, **options) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for (word, n) with distinct words."""
    pairs = materialize(near_pairs(words, **options), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).union(
        pairs.select("b", "b_n", "a", "a_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), "other"))
    near = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.minus") >= times * F.col("n")
    near = materialize(near.select("word", "n_near", F.when(is_form, F.col("best.other")).alias("form"),
                                   F.when(is_form, -F.col("best.minus")).alias("form_n")), "spelling-near")
    roots = materialize(near.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = roots.select(F.col("word").alias("via"), F.col("root").alias("further"))
        step = roots.join(onward, F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = materialize(step, "spelling-roots")
        roots = step.select("word", "root")
        if step.filter("moved").isEmpty():
            break
    found = words.join(near, "word", "left").join(roots, "word", "left")
    return found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form",
                        F.col("form_n").cast("long").alias("form_n"), F.coalesce("root", "word").alias("root"))
