"""Quality rules by repetition coverage.

The words of many texts are hashed and searched for repeats together in numpy: for several
n-gram lengths, the share of a text's characters that lie inside an n-gram found twice or more
in the same text; the share of characters in repeated lines; and the share of symbols. A text
is kept when it passes the base rules and stays under every limit.

Everything is decided inside one row, so the work needs no shuffle and splits as the input does.
Nulls and empty texts have no words: they fail the base rules and are not kept. Equal rows get
equal results. Texts of any length are processed whole; a text longer than a step makes a step
of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diffloom.llm.common import STEP_BYTES, Words, fresh, steps, utf8

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "dup_line_chars double, dup_gram_chars double, symbol_share double, base_failed boolean, kept boolean")


@dataclass(frozen=True)
class Limits:
    """Shares above these reject a text. ``gram_chars``: n-gram length -> share of characters; short n-grams see words
    in runs, which the base rules do not."""

    min_words: int = 10
    repeat_words_percent: int = 20
    gram_chars: tuple[tuple[int, float], ...] = ((2, 0.65), (3, 0.60), (5, 0.30), (7, 0.28), (10, 0.26))
    line_chars: float = 0.35
    symbol_share: float = 0.05
    #: One repeat of so many words may come on top in a text of any length (a share of slack_words / n_words).
    slack_words: int = 4


_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
#: UTF-8 bytes that begin a code point
_LEADS = np.array([b & 0xC0 != 0x80 for b in range(256)])


def _covered(words: Words, n: int) -> np.ndarray:
    """Which words lie in an ``n``-word window found twice or more in their text."""
    out = np.zeros(len(words), bool)
    at, h = words.windows(n, seed=1)
    if not len(at):
        return out
    ordered = np.sort(h)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return out
    place = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
    hit = at[twice[place] == h]
    edges = np.zeros(len(words) + 1, np.int32)
    np.add.at(edges, hit, 1)
    np.add.at(edges, hit + n, -1)
    return np.cumsum(edges[:-1]) > 0


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line: how many, and their characters."""
    lines = text.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0, 0
    seen, count, chars = set(), 0, 0
    for line in lines:
        if line in seen:
            if line.strip():
                count += 1
                chars += len(line.decode("utf-8", "surrogatepass"))
        else:
            seen.add(line)
    return count, chars


def _per_text(values: np.ndarray, words: Words, n_texts: int) -> np.ndarray:
    return np.bincount(words.text, weights=values, minlength=n_texts).astype(np.int64)


def measure(texts: list[bytes], limits: Limits) -> pd.DataFrame:
    """The counts, shares and verdicts of some texts (UTF-8)."""
    words, n = Words(texts), len(texts)
    size = words.end - words.start
    lead = np.concatenate(([0], np.cumsum(_LEADS[words.data])))
    chars = lead[words.end] - lead[words.start] if len(words) else size
    marks = np.concatenate(([0], np.cumsum(_SYMBOLS[words.data])))
    n_words = np.diff(words.first)
    word_chars = _per_text(chars, words, n)
    n_symbols = marks[words.text_at[1:]] - marks[words.text_at[:-1]]
    line_pairs = np.array([_lines(t) for t in texts], np.int64).reshape(n, 2)
    n_chars = lead[words.text_at[1:]] - lead[words.text_at[:-1]] - 1
    share = {}
    repeat_words = np.zeros(n, np.int64)
    for length in sorted({5, *dict(limits.gram_chars)}):
        inside = _covered(words, length)
        if length == 5:
            repeat_words = _per_text(inside, words, n)
        share[length] = _per_text(np.where(inside, chars, 0), words, n) / np.maximum(word_chars, 1)
    line_share = line_pairs[:, 1] / np.maximum(n_chars, 1)
    symbols = n_symbols / np.maximum(word_chars, 1)
    failed = (n_words < limits.min_words) | (100 * repeat_words > limits.repeat_words_percent * n_words)
    slack = limits.slack_words / np.maximum(n_words, 1)
    over = line_share > limits.line_chars + slack
    for length, most in limits.gram_chars:
        over |= share[length] > most + slack
    kept = ~failed & ~over & (symbols <= limits.symbol_share)
    return pd.DataFrame({
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": line_pairs[:, 0],
        "n_repeat_words": repeat_words, "dup_line_chars": line_share,
        "dup_gram_chars": np.max([share[length] for length, _ in limits.gram_chars], axis=0) if limits.gram_chars else 0.0,
        "symbol_share": symbols, "base_failed": failed, "kept": kept})


def rules(text: Column, limits: Limits = Limits()) -> Column:
    """A struct of ``SCHEMA`` for each text."""

    @F.pandas_udf(SCHEMA)
    def measured(column: pd.Series) -> pd.DataFrame:
        parts = [measure(run, limits) for _, run in steps(utf8(column), STEP_BYTES)]
        return pd.concat(parts, ignore_index=True) if parts else measure([], limits)

    return measured(text)


def keep_passing(df: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows whose text is kept, with their columns as they were."""
    name = fresh(df, "__rules")
    return df.withColumn(name, rules(F.col(text), limits)).filter(F.col(f"{name}.kept")).drop(name)
