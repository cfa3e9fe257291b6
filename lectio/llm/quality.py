"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters slide over the bytes of the whole document; their outputs are max-pooled over chunks of two blocks that
overlap by one, a dense layer reads each chunk, and the largest and mean answers of all chunks give one probability.
The network is fitted on the driver on a bounded sample of labelled rows; scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectio.llm.common import keep_nothing, lean, table, texts
from lectio.llm.pieces import slices

#: Bytes that a filter sees, bytes between its places, filters, bytes of a block, cells of the dense layer.
WIDTH, STRIDE, FILTERS, BLOCK, HIDDEN = 8, 4, 32, 256, 16
#: Bounds of the sample that is fitted: labelled rows, and characters of a text to be among them.
TRAIN_ROWS, TRAIN_CHARS = 2000, 50_000
STEPS, BATCH, RATE = 400, 32, 0.004
#: Blocks that the filters slide over at once: a bound of memory alone, whatever the texts' lengths.
SLICE = 256


def _byte_vectors() -> np.ndarray:
    """A fixed vector for each byte: what kind of byte it is, and five random numbers."""
    b = np.arange(256)
    upper, lower = (b >= 65) & (b <= 90), (b >= 97) & (b <= 122)
    kinds = [upper, lower, (b >= 48) & (b <= 57), b == 32, b == 10, (b > 32) & (b < 128) & ~upper & ~lower & ~((b >= 48) & (b <= 57)), b >= 128]
    return np.concatenate([np.array(kinds, np.float32).T, np.random.default_rng(7).normal(0, 0.5, (256, 5)).astype(np.float32)], 1)


VECTORS = _byte_vectors()
IN = WIDTH * VECTORS.shape[1]


def _laid_out(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, each document padded by at least WIDTH zeros to whole blocks; the number of blocks of each."""
    blocks = np.array([(len(x) + WIDTH) // BLOCK + 1 for x in data])
    out = np.zeros(int(blocks.sum()) * BLOCK + WIDTH, np.uint8)
    at = 0
    for x, n in zip(data, blocks.tolist()):
        out[at : at + len(x)] = np.frombuffer(x, np.uint8)
        at += n * BLOCK
    return out, blocks


def _windows(laid: np.ndarray) -> np.ndarray:
    """The vectors of the bytes that each place of a filter sees (places x IN)."""
    v = VECTORS[laid]
    n = (len(laid) - WIDTH) // STRIDE
    return np.lib.stride_tricks.as_strided(v, (n, IN), (v.strides[0] * STRIDE, v.strides[1]))


def _best_places(laid: np.ndarray, ends: np.ndarray, filters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the place of each filter's largest output in each block, that output), a slice of blocks at a time.

    The last places of a document reach into the next one: they count as the one before them, which sees zeros alone.
    """
    n, over = int(ends[-1]), -(-(WIDTH - STRIDE) // STRIDE)
    final = np.zeros(n, bool)
    final[ends - 1] = True
    best, most = np.empty((n, FILTERS), np.int64), np.empty((n, FILTERS), filters.dtype)
    for a in range(0, n, SLICE):
        b = min(a + SLICE, n)
        conv = (_windows(laid[a * BLOCK : b * BLOCK + WIDTH]) @ filters).reshape(-1, BLOCK // STRIDE, FILTERS)
        last = np.flatnonzero(final[a:b])
        conv[last, BLOCK // STRIDE - over :] = conv[last, BLOCK // STRIDE - over - 1][:, None]
        best[a:b] = conv.argmax(1)
        most[a:b] = np.take_along_axis(conv, best[a:b, None], 1)[:, 0]
    return best, most


@dataclass
class Network:
    base: float
    weights: dict[str, np.ndarray] | None = None

    def _forward(self, data: list[bytes]) -> dict:
        w = self.weights
        laid, blocks = _laid_out(data)
        ends = np.cumsum(blocks)
        best, most = _best_places(laid, ends, w["filters"])
        pooled = np.maximum(most + w["shift"], 0)
        partner = np.arange(1, len(pooled) + 1)
        partner[ends - 1] -= 1  # the last block of a document is a chunk of its own
        second = pooled[partner] > pooled
        chunk = np.where(second, pooled[partner], pooled)
        dense = np.maximum(chunk @ w["dense"] + w["dense_shift"], 0)
        starts = ends - blocks
        top, mean = np.maximum.reduceat(dense, starts), np.add.reduceat(dense, starts) / blocks[:, None]
        logit = np.concatenate([top, mean], 1) @ w["out"] + w["out_shift"]
        return locals()

    def score(self, data: list[bytes]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(data), self.base)
        return 1 / (1 + np.exp(-np.clip(self._forward(data)["logit"].astype(np.float64), -30, 30)))

    def gradients(self, data: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
        f, w = self._forward(data), self.weights
        d = (1 / (1 + np.exp(-np.clip(f["logit"], -30, 30))) - labels) / len(data)
        joined = np.concatenate([f["top"], f["mean"]], 1)
        g = {"out": joined.T @ d, "out_shift": d.sum(keepdims=True)}
        d_joined = d[:, None] * w["out"][None]
        doc = np.repeat(np.arange(len(data)), f["blocks"])
        is_top = f["dense"] == f["top"][doc]
        ties = np.add.reduceat(is_top.astype(np.float32), f["starts"])[doc]
        d_dense = (is_top / ties * d_joined[doc, :HIDDEN] + d_joined[doc, HIDDEN:] / f["blocks"][doc, None]) * (f["dense"] > 0)
        g |= {"dense": f["chunk"].T @ d_dense, "dense_shift": d_dense.sum(0)}
        d_chunk = d_dense @ w["dense"].T
        d_pooled = np.where(f["second"], 0, d_chunk)
        np.add.at(d_pooled, f["partner"], np.where(f["second"], d_chunk, 0))
        d_pooled = d_pooled * (f["pooled"] > 0)
        where = (f["best"] + np.arange(len(f["best"]))[:, None] * (BLOCK // STRIDE)) * STRIDE
        seen = lambda k: VECTORS[f["laid"][where[:, k, None] + np.arange(WIDTH)]].reshape(-1, IN)
        g |= {"filters": np.stack([seen(k).T @ d_pooled[:, k] for k in range(FILTERS)], 1), "shift": d_pooled.sum(0)}
        return g


def train(data: list[bytes], labels: list[int], steps: int = STEPS) -> Network:
    """Adam on batches in a fixed random order. Without both labels in the sample the score is the rate of 1 (0.5 of none)."""
    y = np.array(labels, np.float32)
    base = float((y.sum() + 1) / (len(y) + 2))
    if not len(y) or y.min() == y.max():
        return Network(base)
    rng = np.random.default_rng(11)
    shapes = {"filters": (IN, FILTERS), "dense": (FILTERS, HIDDEN), "out": (2 * HIDDEN,)}
    w = {k: rng.normal(0, (2 / s[0]) ** 0.5, s).astype(np.float32) for k, s in shapes.items()}
    w |= {"shift": np.zeros(FILTERS, np.float32), "dense_shift": np.zeros(HIDDEN, np.float32), "out_shift": np.array([np.log(base / (1 - base))], np.float32)}
    net, m, v = Network(base, w), {k: 0.0 for k in w}, {k: 0.0 for k in w}
    order = np.zeros(0, np.int64)
    for t in range(1, steps + 1):
        if len(order) < BATCH:
            order = np.concatenate([order, rng.permutation(len(y))])
        take, order = order[:BATCH], order[BATCH:]
        rate = RATE * (1 - t / (steps + 1))
        for k, g in net.gradients([data[i] for i in take], y[take]).items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt: crc32 of doc_id as text leaves 1 when divided by 3. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Network:
    """Fit on at most ``rows`` labelled documents of at most ``chars`` characters, those with the least hash of doc_id.

    Held-out rows are not used; nor are null labels or ids. Several labels of a document count as one, the least. Only the
    text is an input of the network.
    """
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = texts(docs).filter(F.length("text") <= chars).join(F.broadcast(known), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows).collect()
    return train([r["text"].encode() for r in sample], [int(r["quality"] == 1) for r in sample])


def score(docs: DataFrame, network: Network, name: str = "score") -> DataFrame:
    """documents -> the same columns and ``name``, the probability of quality 1; no shuffle.

    A null text counts as empty. Each row is scored by itself, whatever its id. A column called ``name`` is replaced.
    """
    docs = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_nothing()
        for batch in batches:
            said = [x or "" for x in batch.column("text").to_pylist()]
            found = [network.score([x.encode() for x in said[a:b]]) for a, b in slices(said, 500, 1_000_000)]
            yield batch.append_column(name, pa.array(np.concatenate(found) if found else [], pa.float64()))

    return docs.mapInArrow(lean(run), T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> doc_id, held_out, score, predicted. Null texts and ids, several labels of a document: see fit() and score()."""
    docs = table(spark, sf_dir, "documents")
    network = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), network).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
