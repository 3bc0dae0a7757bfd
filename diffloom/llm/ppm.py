"""Language-model scoring by prediction by partial matching (PPM) over bytes.

A trie of byte contexts up to ``ORDER`` bytes deep is counted over all training documents: each
task counts the (ORDER + 1)-byte strings of its texts in numpy, Spark adds them up, and the
shorter contexts are sums of the longer. A text is scored symbol by symbol from the deepest
context that the trie has: a symbol not seen there costs an escape (method C: distinct symbols
against all) to the next shorter context, where the symbols already ruled out are excluded from
the counts; after the empty context come equal shares of what is left. Because shorter contexts
have seen everything that longer ones have, what is excluded depends on the context escaped
from alone, so whole batches of strings are looked up together. ``adaptive`` scores a text by a
trie that starts empty and learns from the text as it goes.

Size: all counts are kept, in a written table, and no string is left out of a score. The
probability of a string that the training documents have needs its own count and its context's
alone; the commonest (at most ``HEAD_STRINGS``) are broadcast with it (16 bytes each), and a task
emits the other strings of each of its rows, once with their number, to be joined with their
probabilities and summed by row. Strings that no training document has are few and distinct: each
is joined once with the counts of its shorter contexts. Contexts of at most two bytes, to which
very many strings lead, come by broadcast there (their number is bounded by the bytes).

The unigram base counts the training documents' words (and one end for each document). The
commonest (at most ``HEAD_WORDS``, short ones) are broadcast; the occurrences of all the others are
joined with their counts by a shuffle, summed within a document first. So no hot word is shuffled
and every count is used.

Nulls are empty texts. A text is preceded by ``ORDER`` zero bytes and followed by one as its end,
which is scored too, so an empty text has a score. Repeated rows get a row each. A document
without an id is a training document. With no training documents all symbols are equally likely.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diffloom.llm.common import fold_of, steps, utf8
from diffloom.session import materialize

ORDER = 5
HEAD_STRINGS = 1_000_000
HEAD_WORDS = 1 << 16
HEAD_BYTES = 64
#: Bytes of text whose strings are made at once (some 60 bytes of numpy arrays each).
STEP_BYTES = 1 << 20
#: Distinct words that a task holds before it hands its counts on.
HELD_WORDS = 100_000
HELD_STRINGS = 1 << 21


def lowered(texts) -> list[bytes]:
    """UTF-8 with A-Z in lower case."""
    return [t.lower() for t in utf8(texts)]


def strings(run: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The (order + 1)-byte strings that end at each byte of each text and at its end, as numbers,
    and where each text's begin."""
    pad = b"\0" * order
    data = np.frombuffer(b"".join(pad + t + b"\0" for t in run), np.uint8)
    sizes = np.fromiter(map(len, run), np.int64, len(run)) + 1
    begins = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) + np.repeat(np.arange(len(run)) * order, sizes)
    wide = data.astype(np.int64)
    grams = np.zeros(len(at), np.int64)
    for k in range(order + 1):
        grams = grams << 8 | wide[at + k]
    return grams, begins


class Trie:
    """Counts by context, ready for scoring. ``keys[k]``: sorted strings of k context bytes and a
    symbol; ``counts[k]``: how often."""

    def __init__(self, keys: list[np.ndarray], counts: list[np.ndarray]):
        self.keys, self.counts = keys, [c.astype(float) for c in counts]
        self.order = len(keys) - 1
        self.contexts, self.totals, self.distinct = [], [], []
        #: log10 of all / escape in a context, and of those in the shorter one after an escape
        self.own, self.after = [], []
        for k, (key, n) in enumerate(zip(keys, self.counts)):
            context, first = np.unique(key >> 8, return_index=True)
            total = np.add.reduceat(n, first) if len(n) else n
            kinds = np.diff(np.append(first, len(key))).astype(float)
            self.contexts.append(context)
            self.totals.append(total)
            self.distinct.append(kinds)
            self.own.append(self._logs(total, kinds))
            if k == 0:
                self.after.append(None)
                continue
            shorter = (1 << 8 * k) - 1
            above = np.searchsorted(keys[k - 1], key & shorter)
            seen = np.add.reduceat(self.counts[k - 1][above], first) if len(n) else n
            parent = np.searchsorted(self.contexts[k - 1], context & (shorter >> 8))
            self.after.append(self._logs(self.totals[k - 1][parent] - seen, self.distinct[k - 1][parent] - kinds))

    @staticmethod
    def _logs(total: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of a context's whole weight and of its escape; a context with nothing left is passed for free."""
        whole = total + kinds
        some = whole > 0
        escape = np.divide(kinds, whole, out=np.ones_like(whole), where=some)
        return np.log10(np.where(some, whole, 1.0)), np.log10(escape)

    def score(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each string after its other bytes."""
        out = np.zeros(len(grams))
        todo = np.arange(len(grams))
        came = np.full(len(grams), -1)  # the context escaped from
        for k in range(self.order, -1, -1):
            if not len(todo) or not len(self.keys[k]):
                continue
            g = grams[todo] & ((1 << 8 * (k + 1)) - 1)
            place = np.minimum(np.searchsorted(self.contexts[k], g >> 8), len(self.contexts[k]) - 1)
            exists = self.contexts[k][place] == g >> 8
            entry = np.minimum(np.searchsorted(self.keys[k], g), len(self.keys[k]) - 1)
            found = self.keys[k][entry] == g
            escaped = came[todo] >= 0
            whole, escape = self.own[k][0][place], self.own[k][1][place]
            if k < self.order and escaped.any():
                child = came[todo[escaped]]
                whole[escaped], escape[escaped] = self.after[k + 1][0][child], self.after[k + 1][1][child]
            step = np.where(found, np.log10(self.counts[k][entry]) - whole, escape)
            out[todo[exists]] += step[exists]
            came[todo[exists]] = place[exists]
            todo = todo[~(exists & found)]
        left = 256.0 - (self.distinct[0][0] if len(self.keys[0]) else 0.0)
        out[todo] -= np.log10(left) if left else 0.0
        return out


def adaptive(text: bytes, order: int = ORDER) -> float:
    """log10 probability of a text (and its end) by a trie that starts empty and learns as it goes."""
    tables: list[dict[int, Counter]] = [{} for _ in range(order + 1)]
    data, total = b"\0" * order + text + b"\0", 0.0
    for at in range(order, len(data)):
        symbol, barred = data[at], set()
        for k in range(order, -2, -1):
            if k < 0:
                total -= np.log10(256 - len(barred))
                break
            seen = tables[k].get(data[at - k:at])
            if seen is None:
                continue
            left = {s: n for s, n in seen.items() if s not in barred}
            if not left:
                continue
            whole = sum(left.values()) + len(left)
            if symbol in left:
                total += np.log10(left[symbol] / whole)
                break
            total += np.log10(len(left) / whole)
            barred |= set(left)
        for k in range(order + 1):
            tables[k].setdefault(data[at - k:at], Counter())[symbol] += 1
    return float(total)


def count_strings(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, n) over all texts of the one column of ``texts``."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for _, run in steps(lowered(batch.iloc[:, 0]), STEP_BYTES):
                held.append(np.unique(strings(run, order)[0], return_counts=True))
                if sum(len(grams) for grams, _ in held) >= HELD_STRINGS:
                    yield _added(held)
                    held = []
        if held:
            yield _added(held)

    def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        grams, place = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
        return pd.DataFrame({"gram": grams, "n": np.bincount(place, np.concatenate([n for _, n in held]), len(grams)).astype(np.int64)})

    return texts.mapInPandas(counted, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts of the one column of ``texts``; the end is the empty word."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for batch in batches:
            for t in lowered(batch.iloc[:, 0]):
                held.update(t.split())
                held[b""] += 1
                if len(held) >= HELD_WORDS:
                    yield _frame(held)
                    held = Counter()
        if held:
            yield _frame(held)

    def _frame(held: Counter) -> pd.DataFrame:
        return pd.DataFrame({"word": [w.decode("utf-8", "surrogatepass") for w in held], "n": list(held.values())})

    return texts.mapInPandas(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def least_count(counts: DataFrame, most: int) -> int:
    """The smallest of 8 steps an octave such that at most ``most`` rows have ``n`` no smaller."""
    level = F.ceil(F.log2("n") * 8).cast("int")
    rows = counts.groupBy(level.alias("level")).agg(F.count("*").alias("rows"), F.min("n").alias("n")).collect()
    total, least = 0, 2**62  # some 500 levels at most
    for r in sorted(rows, key=lambda r: -r.level):
        total += r.rows
        if total > most:
            break
        least = r.n
    return least


def trie_table(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(k, gram, n): all strings of k context bytes and a symbol, over all texts of the one column of ``texts``."""
    longest = materialize(count_strings(texts, order), "ppm-strings")
    shorter = F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("gram")) for k in range(order)]))
    every = longest.select(shorter.alias("s"), "n").groupBy("s.k", "s.gram").agg(F.sum("n").alias("n")) if order else \
        longest.limit(0).select(F.lit(0).alias("k"), "gram", "n")
    return materialize(every.union(longest.select(F.lit(order).alias("k"), "gram", "n")), "ppm-trie")


def fit(texts: DataFrame, order: int = ORDER, most: int = HEAD_STRINGS) -> Trie:
    """A trie of the commonest strings, at most ``most``, for use in one process. ``language_model``
    scores by the whole table instead."""
    every = trie_table(texts, order)
    kept = every.filter(F.col("n") >= least_count(every, most)).toArrow()  # at most ``most`` rows
    level, gram, n = (kept.column(c).to_numpy() for c in ("k", "gram", "n"))
    keys, counts = [], []
    for k in range(order + 1):
        own = np.flatnonzero(level == k)
        own = own[np.argsort(gram[own])]
        keys.append(gram[own])
        counts.append(n[own])
    return Trie(keys, counts)


def _last(column: str, k: str) -> Column:
    """The last ``k`` bytes of a string."""
    return F.expr(f"{column} & (shiftleft(1L, 8 * ({k})) - 1)")


def contexts(trie: DataFrame) -> DataFrame:
    """(k, context, own, own_escape, after, after_escape): of each context of ``trie_table`` the log10 of
    its whole weight and of its escape, and both for the next shorter one after an escape from it."""
    above = trie.select((F.col("k") + 1).alias("k"), F.col("gram").alias("upper"), F.col("n").alias("above"))
    entries = trie.withColumn("upper", _last("gram", "k")).join(above, ["k", "upper"], "left")  # at most 256 to one
    sums = materialize(entries.groupBy("k", F.expr("gram >> 8").alias("context")).agg(
        F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("above").alias("seen")), "ppm-contexts")
    parent = sums.select((F.col("k") + 1).alias("k"), F.col("context").alias("upper"),
                         F.col("total").alias("all_total"), F.col("kinds").alias("all_kinds"))
    left = F.col("all_kinds") - F.col("kinds")
    whole = F.col("all_total") - F.col("seen") + left
    return sums.withColumn("upper", _last("context", "k - 1")).join(parent, ["k", "upper"], "left").select(
        "k", "context", F.log10(F.col("total") + F.col("kinds")).alias("own"),
        F.log10(F.col("kinds") / (F.col("total") + F.col("kinds"))).alias("own_escape"),
        F.when(whole > 0, F.log10(whole)).otherwise(0.0).alias("after"),
        F.when(whole > 0, F.log10(left / whole)).otherwise(0.0).alias("after_escape"))


def unseen(grams: DataFrame, trie: DataFrame, context: DataFrame, order: int) -> DataFrame:
    """(gram, weight): log10 probability of strings (distinct) that the training documents do not have. Of the
    longest context that exists comes its escape, of each shorter one the escape after the last, until one has the symbol."""
    root = trie.filter("k = 0").agg(F.count("*")).first()[0]
    rest = math.log10(256 - root) if root < 256 else 0.0
    tagged = "shiftleft(CAST({} AS BIGINT), 56) | {}"  # a level (contexts: from 8) before at most seven bytes
    empty = [F.lit(None).cast("double").alias(c) for c in ("own", "own_escape", "after", "after_escape")]
    values = trie.filter(F.col("k") < order).select("k", F.expr(tagged.format("k", "gram")).alias("key"), F.col("n"), *empty).union(
        context.select("k", F.expr(tagged.format("k + 8", "context")), F.lit(None).cast("long"),
                       "own", "own_escape", "after", "after_escape"))
    looked = grams.select("gram", F.explode(F.array(
        *[F.struct(F.lit(k).alias("k"), F.lit(k << 56).bitwiseOR(F.col("gram").bitwiseAND((1 << 8 * (k + 1)) - 1)).alias("key"))
          for k in range(order)],
        *[F.struct(F.lit(k).alias("k"), F.lit(k + 8 << 56).bitwiseOR(F.expr(f"(gram >> 8) & {(1 << 8 * k) - 1}L")).alias("key"))
          for k in range(order + 1)])).alias("s")).select("gram", "s.k", "s.key")
    low = (F.col("k") < 2) | (F.col("k") == 2) & F.expr("key >> 56 = 10")  # at most 65,536 strings and as many contexts
    found = looked.filter(low).join(F.broadcast(values.filter(low).drop("k")), "key").union(
        looked.filter(~low).join(values.filter(~low).drop("k"), "key"))
    levels = found.groupBy("gram").agg(
        F.max(F.when(F.col("n").isNotNull(), F.struct("k", "n"))).alias("hit"),
        F.max(F.when(F.col("own").isNotNull(), F.struct("k", "own", "own_escape"))).alias("deep"),
        F.array_sort(F.collect_list(F.when(F.col("own").isNotNull(), F.struct("k", "after", "after_escape")))).alias("path"))
    escapes = F.expr("aggregate(filter(path, c -> c.k > coalesce(hit.k, -1) + 1), 0D, (a, c) -> a + c.after_escape)")
    weight = F.when(F.col("hit.k") == F.col("deep.k"), F.log10("hit.n") - F.col("deep.own")).otherwise(
        F.col("deep.own_escape") + escapes + F.coalesce(F.log10("hit.n") - F.expr("path[hit.k + 1].after"), F.lit(-rest)))
    return grams.join(levels.select("gram", weight.alias("weight")), "gram", "left").select(
        "gram", F.coalesce("weight", F.lit(-rest)).alias("weight"))


SCORED = ("row long, doc_id long, held_out boolean, n_tokens long, score double, grams array<long>, gram_times array<int>, "
          "head_known long, head_score double, words array<string>, times array<int>")


def others_of(grams: np.ndarray, begins: np.ndarray, known: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each text its distinct strings that are not ``known``, and how often each is there."""
    at = np.flatnonzero(~known)
    text, gram = np.searchsorted(begins, at, "right") - 1, grams[at]
    by = np.lexsort((gram, text))
    text, gram = text[by], gram[by]
    first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (gram[1:] != gram[:-1]))[:len(by)])
    times = np.diff(np.append(first, len(by))).astype(np.int32)
    cuts = np.searchsorted(text[first], np.arange(1, len(begins)))
    return np.split(gram[first], cuts), np.split(times, cuts)


def score(df: DataFrame, strong: Broadcast, head: Broadcast, held_out: Column, id_col: str, text: str, order: int) -> DataFrame:
    """One row of ``SCORED`` for each row of ``df``; ``strong``: common strings, sorted, and their log10
    probabilities; ``grams`` and ``gram_times``: the others, and how often; ``head``: word -> log10
    weight of common words; ``words`` and ``times``: the others, and how often."""
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                     held_out.alias("held_out"), F.col(text).alias("text"))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (keys, weights), common = strong.value, head.value
        for batch in batches:
            texts = lowered(batch["text"])
            sums, grams_of, gram_times = [], [], []
            for _, run in steps(texts, STEP_BYTES):
                grams, begins = strings(run, order)
                kinds, place = np.unique(grams, return_inverse=True)
                entry = np.minimum(np.searchsorted(keys, kinds), max(0, len(keys) - 1))
                sure = keys[entry] == kinds if len(keys) else np.zeros(len(kinds), bool)
                sums.append(np.add.reduceat((np.where(sure, weights[entry], 0.0) if len(keys) else np.zeros(len(kinds)))[place], begins))
                for held, new in zip((grams_of, gram_times), others_of(grams, begins, sure[place])):
                    held += new
            n_tokens, known, base, rest, times = [], [], [], [], []
            for t in texts:
                words = t.split()
                n_tokens.append(len(words) + 1)
                words.append(b"")
                found = [w for w in map(common.get, words) if w is not None]
                known.append(len(found))
                base.append(sum(found))
                others = Counter(w for w in words if w not in common) if len(found) < len(words) else {}
                rest.append([w.decode("utf-8", "surrogatepass") for w in others])
                times.append(np.fromiter(others.values(), np.int32, len(others)))
            yield pd.DataFrame({"row": batch["row"], "doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"],
                                "n_tokens": n_tokens, "score": np.concatenate(sums), "grams": pd.Series(grams_of, dtype=object),
                                "gram_times": pd.Series(gram_times, dtype=object), "head_known": known,
                                "head_score": base, "words": pd.Series(rest, dtype=object), "times": pd.Series(times, dtype=object)})

    return rows.mapInPandas(scored, SCORED)


def language_model(df: DataFrame, id_col: str = "doc_id", text: str = "text", held_fold: int = 1, order: int = ORDER,
                   most: int = HEAD_STRINGS, head_words: int = HEAD_WORDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``df``;
    both models learn from the rows whose fold is not ``held_fold``. ``most`` strings and ``head_words`` words are
    broadcast at most; the result is the same whatever they are."""
    context = df.sparkSession.sparkContext
    held_out = fold_of(id_col) == held_fold
    train = df.filter(~held_out).select(text)
    trie = trie_table(train, order)
    above = contexts(trie)
    longest = materialize(
        trie.filter(F.col("k") == order).withColumn("context", F.expr("gram >> 8")).join(
            above.filter(F.col("k") == order).select("context", "own"), "context").select(
            "gram", "n", (F.log10("n") - F.col("own")).alias("weight")), "ppm-weights")
    least = least_count(longest, most)
    kept = longest.filter(F.col("n") >= least).select("gram", "weight").toArrow()  # at most ``most`` rows
    keys, weights = (kept.column(c).to_numpy() for c in ("gram", "weight"))
    by = np.argsort(keys)
    strong = context.broadcast((keys[by], weights[by]))
    counts = materialize(count_words(train), "unigrams")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    whole = n + 0.5 * (v + 1)
    common = counts.filter(F.octet_length("word") <= HEAD_BYTES)
    common = common.filter(F.col("n") >= least_count(common, head_words)).collect()  # at most HEAD_WORDS short words
    head = context.broadcast({r.word.encode("utf-8", "surrogatepass"): float(np.log10((r.n + 0.5) / whole)) for r in common})
    rows = materialize(score(df, strong, head, held_out, id_col, text, order), "lm-rows")
    pairs = rows.select("row", "held_out", F.explode(F.arrays_zip("grams", "gram_times")).alias("g")).select(
        "row", "held_out", F.col("g.grams").alias("gram"), F.col("g.gram_times").alias("times"))
    fresh_grams = pairs.filter("held_out").select("gram").distinct().join(longest.select("gram"), "gram", "left_anti")
    fresh_grams = materialize(fresh_grams, "ppm-fresh")
    known = longest.filter(F.col("n") < least).select("gram", "weight").union(unseen(fresh_grams, trie, above, order))
    strings_of = pairs.join(known, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("weight")).alias("rest_strings"))
    others = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    joined = others.join(counts, "word", "left").select("row", "times", F.coalesce("n", F.lit(0)).alias("n"))
    weight = F.log10((F.col("n") + 0.5) / F.lit(whole))
    sums = joined.groupBy("row").agg(F.sum(F.col("times") * weight).alias("rest_score"),
                                     F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rest_known"))
    zero = F.lit(0)
    return rows.join(sums, "row", "left").join(strings_of, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("rest_known", zero)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("head_score") + F.coalesce("rest_score", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rest_strings", F.lit(0.0))).alias("score"))
