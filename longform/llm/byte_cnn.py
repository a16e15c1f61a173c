"""Quality classifier: a convolutional network over the bytes of a whole document, in numpy.

A text's UTF-8 bytes are padded with zeros to blocks of ``BLOCK`` bytes. Learned filters of
``WIDTH`` bytes (one weight for each place, byte value and filter) run over every position.
Overlapping chunks of two neighbouring blocks are max-pooled, so the chunks cover the whole
document, however long; the mean and the maximum of the pooled filters over all chunks go
through a small dense layer to one probability that the quality label is 1.

``train`` learns from whole texts of at most ``SAMPLE`` labelled documents of each class (the smallest
hashes of their ids), as far as they have ``SAMPLE_BYTES`` bytes together; both are
bounds on what the driver holds. Weights of the classes restore their true shares.
Scoring reads every byte of every document, one Arrow batch after another.

Null and empty texts are one block of zeros and get a score as well. Labels that are null or
neither 0 nor 1 are not learned from. Of several texts under one doc_id the smallest is learned from. Without any label, or with one class alone, every score
is the same (0.5, or that class). Repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from longform.llm.shipping import ship
from longform.llm.workers import enter
from longform.llm.wordhash import utf8

BLOCK = 128
WIDTH = 8
FILTERS = 24
HIDDEN = 16
SAMPLE = 1500
SAMPLE_BYTES = 32_000_000
EPOCHS = 10
BATCH_DOCS = 48
RATE = 0.01
DECAY = 1e-4
SCORED_BYTES = 1 << 17
#: Stands for filters that would reach into the next text; smaller than any sum of weights.
LOWEST = np.float32(-1e9)


def padded(text: bytes) -> bytes:
    """Zeros after the text, at least as many as a filter reaches, up to whole blocks."""
    size = -(-(len(text) + WIDTH - 1) // BLOCK) * BLOCK
    return text.ljust(size, b"\0")


def _crossing(ends: np.ndarray) -> np.ndarray:
    """Positions from which a filter reaches beyond the end of its text. They hold padding only."""
    return (ends[:, None] - np.arange(1, WIDTH)).ravel()


@dataclass
class Network:
    """filters: place x byte x filter; the other arrays are the biases and the two dense layers."""

    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    constant: float | None = None

    def parameters(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.dense, self.dense_bias, self.out, self.out_bias]

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
        return Network(
            draw(0.3, WIDTH, 256, FILTERS), np.zeros(FILTERS, np.float32), draw(0.2, 2 * FILTERS, HIDDEN), np.zeros(HIDDEN, np.float32),
            draw(0.3, HIDDEN), np.zeros(1, np.float32),
        )


def _chunks(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of documents with n blocks each: the first and second block of every chunk, and the first chunk of every document."""
    starts = np.cumsum(n) - n
    count = np.maximum(n - 1, 1)
    first_chunk = np.cumsum(count) - count
    first = np.arange(int(count.sum())) - np.repeat(first_chunk - starts, count)
    second = first + np.repeat((n > 1).astype(np.int64), count)
    return first, second, first_chunk


def _head(net: Network, pooled: np.ndarray, n: np.ndarray):
    """Everything after the blocks' maxima, with what the backward pass needs."""
    first, second, start = _chunks(n)
    later = pooled[second] > pooled[first]
    raw = np.where(later, pooled[second], pooled[first]) + net.bias
    act = np.maximum(raw, 0)
    count = np.diff(np.append(start, len(act))).astype(np.float32)[:, None]
    mean, most = np.add.reduceat(act, start) / count, np.maximum.reduceat(act, start)
    features = np.concatenate([mean, most], 1)
    hidden = np.maximum(features @ net.dense + net.dense_bias, 0)
    logit = hidden @ net.out + net.out_bias[0]
    return logit, (first, second, start, later, raw, act, count, most, features, hidden)


def probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -40, 40)))


class Scorer:
    """Scores texts. Filters are laid out by pairs of bytes, so a position costs WIDTH / 2 look-ups."""

    def __init__(self, net: Network):
        self.net = net
        self.pairs = [
            (net.filters[k][:, None, :] + net.filters[k + 1][None, :, :]).reshape(1 << 16, FILTERS) for k in range(0, WIDTH, 2)
        ]

    def _maxima(self, data: bytes, start: int, ends: np.ndarray) -> np.ndarray:
        """Maxima of the blocks from ``start`` on, SCORED_BYTES at most. ``ends``: where the texts end."""
        n = min(len(data) - start, SCORED_BYTES)
        x = np.frombuffer(data[start : start + n + WIDTH].ljust(n + WIDTH, b"\0"), np.uint8).astype(np.int32)
        pair = (x[:-1] << 8) | x[1:]
        out = self.pairs[0].take(pair[:n], 0)
        for k, table in enumerate(self.pairs[1:], 1):
            out += table.take(pair[2 * k : 2 * k + n], 0)
        out[_crossing(ends[(ends > start) & (ends <= start + n)] - start)] = LOWEST
        return out.reshape(-1, BLOCK, FILTERS).max(1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.net.constant is not None:
            return np.full(len(texts), self.net.constant)
        scores, held, size = [], [], 0
        for i, text in enumerate(texts):
            held.append(padded(text))
            size += len(held[-1])
            if size >= SCORED_BYTES or i + 1 == len(texts):
                data = b"".join(held)
                n = np.array([len(h) // BLOCK for h in held])
                ends = np.cumsum(n) * BLOCK
                pooled = np.concatenate([self._maxima(data, a, ends) for a in range(0, len(data), SCORED_BYTES)])
                scores.append(probability(_head(self.net, pooled, n)[0]))
                held, size = [], 0
        return np.concatenate([np.zeros(0), *scores])


def _strongest(net: Network, x: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's maximum in each block, and its place there; so many bytes at a time."""
    pooled, best = [], []
    for a in range(0, len(x) - WIDTH, SCORED_BYTES):
        size = min(SCORED_BYTES, len(x) - WIDTH - a)
        conv = net.filters[0].take(x[a : a + size], 0)
        for k in range(1, WIDTH):
            conv += net.filters[k].take(x[a + k : a + k + size], 0)
        conv[_crossing(ends[(ends > a) & (ends <= a + size)] - a)] = LOWEST
        conv = conv.reshape(-1, BLOCK, FILTERS)
        best.append(conv.argmax(1))
        pooled.append(np.take_along_axis(conv, best[-1][:, None], 1)[:, 0])
    return np.concatenate(pooled), np.concatenate(best)


def train_network(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Network:
    """Weighted logistic loss by Adam. ``texts`` are padded to whole blocks."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed + 1)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        rate = RATE * (1 - epoch / epochs) + RATE * 0.05
        for at in range(0, len(order), BATCH_DOCS):
            chosen = order[at : at + BATCH_DOCS]
            n = np.array([len(texts[i]) // BLOCK for i in chosen])
            x = np.frombuffer(b"".join([texts[i] for i in chosen]) + bytes(WIDTH), np.uint8)
            pooled, best = _strongest(net, x, np.cumsum(n) * BLOCK)
            logit, (first, second, start, later, raw, act, count, most, features, hidden) = _head(net, pooled, n)

            g = ((probability(logit) - labels[chosen]) * weights[chosen] / len(chosen)).astype(np.float32)
            d_hidden = np.outer(g, net.out) * (hidden > 0)
            d_features = d_hidden @ net.dense.T
            per_chunk = np.diff(np.append(start, len(act)))
            d_act = np.repeat(d_features[:, :FILTERS] / count, per_chunk, 0)
            d_act += np.repeat(d_features[:, FILTERS:], per_chunk, 0) * (act == np.repeat(most, per_chunk, 0))
            d_raw = d_act * (raw > 0)
            chunk, column = np.nonzero(d_raw)
            value = d_raw[chunk, column]
            block = np.where(later[chunk, column], second[chunk], first[chunk])
            place = block * BLOCK + best[block, column]
            d_filters = np.zeros_like(net.filters)
            for k in range(WIDTH):
                flat = x[place + k].astype(np.int64) * FILTERS + column
                d_filters[k] = np.bincount(flat, value, 256 * FILTERS).reshape(256, FILTERS)
            grads = [d_filters, d_raw.sum(0), features.T @ d_hidden, d_hidden.sum(0), hidden.T @ g, np.array([g.sum()], np.float32)]

            step += 1
            for p, d, (m, v) in zip(net.parameters(), grads, moments, strict=True):
                d = d + DECAY * p
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
    return net


def held_out(doc_id: Column) -> Column:
    """Documents kept for measuring: a fifth, by the checksum of the id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> Network:
    """A network from ``labels.quality``, without the held-out documents."""
    ship(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id"))).distinct()
    known = known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    shares = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    net = Network.fresh()
    if len(shares) < 2:
        net.constant = float(next(iter(shares), 0.5))
        return net
    ordered = F.xxhash64("doc_id")
    chosen = [known.where(F.col("quality") == q).orderBy(ordered, "doc_id").limit(sample) for q in (0, 1)]
    wanted = chosen[0].unionByName(chosen[1])

    # at most 2 * sample rows and SAMPLE_BYTES, but for one text a class
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(wanted), "doc_id")
    texts = texts.groupBy("doc_id", "quality").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    before = Window.partitionBy("quality").orderBy(ordered, "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    held = F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0))
    bounded = texts.withColumn("held", held).withColumn("all", held + F.octet_length("text"))
    rows = bounded.where(f"held = 0 OR all <= {SAMPLE_BYTES // 2}").select("doc_id", "quality", "text").collect()
    rows = sorted((r["doc_id"], r["quality"], padded(utf8(r["text"]))) for r in rows)
    if not rows:
        net.constant = 0.5
        return net
    y = np.array([r[1] for r in rows], np.float32)
    total = sum(shares.values())
    weights = np.ones(len(y), np.float32)
    for q in (0, 1):
        weights[y == q] = shares[q] / total * len(y) / max(int((y == q).sum()), 1)
    return train_network([r[2] for r in rows], y, weights, epochs=epochs)


def score(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id and score of every row."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # 200 kB

    def scored(batches: Iterator) -> Iterator:
        import pandas as pd

        enter("byte_cnn")
        scorer = Scorer(shared.value)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": scorer.score([utf8(t) for t in batch["text"]])})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(scored, "doc_id long, score double")


def keep_good(docs: DataFrame, net: Network, least: float = 0.3) -> DataFrame:
    """The rows, with all columns, whose score is at least ``least``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def scores(texts):
        import pandas as pd

        enter("byte_cnn")
        scorer = Scorer(shared.value)
        for batch in texts:
            yield pd.Series(scorer.score([utf8(t) for t in batch]))

    udf = F.pandas_udf(scores, "double", F.PandasUDFType.SCALAR_ITER)
    return docs.where(udf(F.col("text")) >= least)
