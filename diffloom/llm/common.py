"""Helpers that the operators share: session settings, column names, words as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom.session import ship_package
from diffloom.sources.tables import load_table

#: Bytes of text that one numpy step works on at once; longer single texts make a step of their own.
STEP_BYTES = 1 << 20
#: The rows of one Arrow batch hold at most about so many bytes.
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Make this package importable in Python workers and bound the Arrow batches by bytes."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return load_table(spark, sf_dir, "documents")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold_of(id_column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; -1 for rows without an id, which no fold holds out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5, F.lit(-1))


def steps(texts: Iterable[bytes], limit: int = STEP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``limit`` bytes together, each with the position of its first."""
    first, run, size = 0, [], 0
    for t in texts:
        if run and size + len(t) > limit:
            yield first, run
            first, run, size = first + len(run), [], 0
        run.append(t)
        size += len(t)
    if run:
        yield first, run


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers that depend on the seed and the index alone."""
    with np.errstate(over="ignore"):
        step = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(step + np.uint64(seed))


_BYTE_VALUES = stream(1, 256)
_POSITIONS = stream(2, 1 << 12) | np.uint64(1)


def position_keys(n: int) -> np.ndarray:
    """At least ``n`` odd keys, one for each position inside a word."""
    global _POSITIONS
    if n > len(_POSITIONS):
        _POSITIONS = stream(2, 1 << int(n - 1).bit_length()) | np.uint64(1)
    return _POSITIONS


class Words:
    """The words (runs of bytes other than ASCII white space) of some texts.

    ``data``: all texts, each followed by a newline; ``text_at``: where each begins, and the
    end; ``start``, ``end``: byte span of each word in ``data``; ``text``: its text's index;
    ``hash``: 64-bit hash of its bytes (multilinear, keyed by position).
    """

    def __init__(self, texts: list[bytes], hashes: bool = True):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.text_at = np.concatenate(([0], np.cumsum(sizes)))
        space = _SPACE[self.data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(space) and not space[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]
        self.text = np.searchsorted(self.text_at, self.start, "right") - 1
        #: words[t]:words[t + 1] are the words of text t
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))
        if hashes:
            self.hash = self._hash()

    def __len__(self) -> int:
        return len(self.start)

    def _hash(self) -> np.ndarray:
        length = self.end - self.start
        if not len(length):
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            total = np.cumsum(length)
            begins = total - length
            offset = np.arange(total[-1]) - np.repeat(begins, length)
            source = self.data[offset + np.repeat(self.start, length)]
            keyed = _BYTE_VALUES[source] * position_keys(int(length.max()))[offset]
            return mix(np.add.reduceat(keyed, begins) + length.astype(np.uint64))

    def windows(self, n: int, seed: int = 0, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Index of each word that begins ``n`` words of one text (or of one ``group``), and the
        windows' hashes. Equal windows of different texts get different hashes only if ``seed``
        is given."""
        if len(self) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        group = self.text if group is None else group
        at = np.flatnonzero(group[n - 1:] == group[: len(self) - n + 1])
        keys = stream(1000 + n, n + 1) | np.uint64(1)
        with np.errstate(over="ignore"):
            h = np.zeros(len(self) - n + 1, np.uint64)
            for k in range(n):
                h += self.hash[k: len(self) - n + 1 + k] * keys[k]
            h = h[at]
            if seed:
                h = h + (self.text[at].astype(np.uint64) + np.uint64(seed)) * keys[n]
            return at, mix(h)


def utf8(texts) -> list[bytes]:
    """The texts of a pandas column as UTF-8; null is the empty text."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
