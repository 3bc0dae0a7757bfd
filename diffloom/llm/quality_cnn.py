"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. In each chunk, learned
filters slide over the embedded bytes, and each filter's largest response in the chunk is kept. The
chunk vectors of a document are combined by mean, maximum and minimum into one logistic unit,
whose output is the probability of label 1. Embedding, filters and unit are learned together, by
Adam on the log loss; the gradient of a maximum goes to the window that won.

Fitted on the driver to a bounded sample: about ``SAMPLE_DOCUMENTS`` labelled texts (never more than
twice as many) of at most ``SAMPLE_CHARS`` code points each, chosen by a hash of the id. Only
texts and labels of rows outside the held-out fold are learned from; the score of a text depends on
its bytes alone. Scoring reads every text whole and needs no shuffle; the weights are broadcast (a
few kilobytes).

Nulls and empty texts are one empty chunk. Equal texts have equal scores. Rows without an id
are not held out; labels without a document, or without a value, are not used. Without labels of
both kinds every score is the share of label 1 (0.5 if there are no labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diffloom.llm.common import fold_of, steps, utf8

WIDTH = 8  # bytes under a filter
DEPTH = 4  # numbers for each byte
FILTERS = 32
CHUNK = 512  # bytes; neighbouring chunks share at least WIDTH of them
STRIDE = 2  # bytes from one window to the next
SAMPLE_DOCUMENTS = 4000
SAMPLE_CHARS = 20_000
EPOCHS = 12
BATCH = 32
THRESHOLD = 0.3
#: Chunks convolved at once.
BLOCK = 256


@dataclass
class Net:
    embedding: np.ndarray  # 256 x DEPTH
    filters: np.ndarray  # FILTERS x WIDTH x DEPTH
    bias: np.ndarray  # FILTERS
    unit: np.ndarray  # 3 x FILTERS: mean, maximum, minimum over chunks
    offset: np.ndarray  # 1

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.unit, self.offset]


def chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(chunks x CHUNK bytes, index of each text's first chunk). The last chunk of a longer text ends
    with the text; a shorter text is filled with zero bytes."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    number = 1 + np.maximum(0, -(-(sizes - CHUNK) // (CHUNK - WIDTH)))
    first = np.cumsum(number) - number
    owner = np.repeat(np.arange(len(texts)), number)
    at = (np.arange(number.sum()) - first[owner]) * (CHUNK - WIDTH)
    at = np.maximum(0, np.minimum(at, sizes[owner] - CHUNK))
    data = np.frombuffer(b"".join(texts) + b"\0" * CHUNK, np.uint8)
    begins = np.cumsum(sizes) - sizes
    place = at[:, None] + np.arange(CHUNK)[None, :]
    inside = place < sizes[owner][:, None]
    return np.where(inside, data[np.where(inside, place + begins[owner][:, None], 0)], 0).astype(np.uint8), first


def respond(net: Net, data: np.ndarray, winners: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """(chunks x FILTERS largest responses, at least 0; the positions where they were)."""
    weights = net.filters.reshape(FILTERS, -1).T.astype(np.float32)
    n = (CHUNK - WIDTH) // STRIDE + 1
    best, where = np.empty((len(data), FILTERS), np.float32), np.empty((len(data), FILTERS), np.int64) if winners else None
    table = net.embedding.astype(np.float32)
    for a in range(0, len(data), BLOCK):
        part = table[data[a:a + BLOCK]].reshape(-1, CHUNK * DEPTH)
        windows = np.lib.stride_tricks.sliding_window_view(part, WIDTH * DEPTH, axis=1)[:, ::STRIDE * DEPTH]
        found = (windows.reshape(-1, WIDTH * DEPTH) @ weights).reshape(len(part), n, FILTERS)
        if winners:
            where[a:a + BLOCK] = found.argmax(axis=1) * STRIDE
        best[a:a + BLOCK] = found.max(axis=1)
    return np.maximum(best + net.bias.astype(np.float32), 0.0), where


def pooled(responses: np.ndarray, first: np.ndarray) -> np.ndarray:
    """texts x 3 x FILTERS."""
    number = np.diff(np.append(first, len(responses)))[:, None]
    return np.stack([np.add.reduceat(responses, first) / number, np.maximum.reduceat(responses, first),
                     np.minimum.reduceat(responses, first)], axis=1)


def probability(net: Net, texts: list[bytes]) -> np.ndarray:
    out = []
    for _, run in steps(texts):
        data, first = chunks(run)
        logit = (pooled(respond(net, data)[0], first) * net.unit).sum(axis=(1, 2)) + net.offset[0]
        out.append(1.0 / (1.0 + np.exp(-np.clip(logit.astype(float), -30, 30))))
    return np.concatenate(out) if out else np.zeros(0)


def gradient(net: Net, texts: list[bytes], labels: np.ndarray) -> list[np.ndarray]:
    """Of the mean log loss, in the order of ``Net.parts``."""
    data, first = chunks(texts)
    responses, where = respond(net, data, winners=True)
    number = np.diff(np.append(first, len(data)))
    owner = np.repeat(np.arange(len(texts)), number)
    features = pooled(responses, first)
    logit = (features * net.unit).sum(axis=(1, 2)) + net.offset[0]
    error = (1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30))) - labels) / len(texts)
    down = np.repeat(net.unit[0][None] / number[:, None], number, axis=0)
    for k, extreme in ((1, features[:, 1]), (2, features[:, 2])):
        won = responses == extreme[owner]
        share = np.add.reduceat(won.astype(float), first)
        down = down + net.unit[k][None] * won / share[owner]
    down = down * error[owner][:, None] * (responses > 0)
    at = where[:, :, None] + np.arange(WIDTH)[None, None, :]
    values = np.take_along_axis(data[:, None, :], at, axis=2)
    embedded = net.embedding[values]
    d_filters = np.einsum("cf,cfwd->fwd", down, embedded)
    spread = down[:, :, None, None] * net.filters[None]
    d_embedding = np.stack([np.bincount(values.ravel(), spread[..., d].ravel(), 256) for d in range(DEPTH)], axis=1)
    return [d_embedding, d_filters, down.sum(axis=0), (features * error[:, None, None]).sum(axis=0), np.array([error.sum()])]


def train(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, decay: float = 1e-3,
          seed: int = 3) -> Net:
    rng = np.random.default_rng(seed)
    net = Net(rng.normal(size=(256, DEPTH)) * 0.5, rng.normal(size=(FILTERS, WIDTH, DEPTH)) * 0.3, np.zeros(FILTERS),
              rng.normal(size=(3, FILTERS)) * 0.05, np.zeros(1))
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        share = min(max(share, 0.001), 0.999)
        net.unit[:], net.offset[:] = 0.0, np.log(share / (1 - share))
        return net
    net.offset[:] = np.log(share / (1 - share))
    mean, square, step = [np.zeros_like(p) for p in net.parts()], [np.zeros_like(p) for p in net.parts()], 0
    total = epochs * -(-len(texts) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            own = order[a:a + BATCH]
            step += 1
            now = rate * (1 - 0.9 * step / total)
            for p, g, m, s in zip(net.parts(), gradient(net, [texts[i] for i in own], labels[own]), mean, square):
                g = g + decay * p if p is not net.offset else g
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return net


def sample(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text: str = "text",
           held_fold: int = 0, n: int = SAMPLE_DOCUMENTS) -> tuple[list[bytes], np.ndarray]:
    """About ``n`` labelled texts outside the held-out fold, by a hash of the id, in its order."""
    usable = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & (fold_of(id_col) != held_fold)).select(
        F.col(id_col).alias("_id"), F.col(label).cast("double").alias("_label"))
    share = min(1.0, n / max(1, usable.count()))
    h = F.pmod(F.xxhash64("_id"), F.lit(2**31))
    chosen = usable.filter(h < int(share * 2**31)).orderBy(F.xxhash64("_id"), "_label").limit(2 * n)
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))
    texts = texts.filter(F.length("_text") <= SAMPLE_CHARS)
    rows = (texts.join(F.broadcast(chosen), "_id")  # 2 n short rows at most
            .orderBy(F.xxhash64("_id"), "_label", "_text").limit(2 * n).collect())
    return utf8([r._text for r in rows]), np.array([r._label for r in rows])


def fit(docs: DataFrame, labels: DataFrame, **options) -> Broadcast:
    return docs.sparkSession.sparkContext.broadcast(train(*sample(docs, labels, **options)))


def score(text: Column, net: Broadcast) -> Column:
    """Probability of label 1 for each text."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            yield pd.Series(probability(net.value, utf8(column)))

    return scored(text)
