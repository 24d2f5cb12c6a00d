"""Quality classifier: a convolutional network over bytes, in numpy.

A text's UTF-8 bytes are cut into chunks of ``CHUNK`` bytes that overlap by ``WIDTH`` - 1, so
every window of ``WIDTH`` bytes of the whole text lies in some chunk. Bytes are embedded,
``FILTERS`` learned filters run over all windows, each chunk keeps
each filter's maximum, and the mean and the maximum of these over all chunks of the text,
with the chunks' mean fill (a short chunk has lower maxima), are combined by a small hidden
layer into one probability.

Learning: at most ``SAMPLE`` labelled rows per class, chosen by a hash of the id (never held-out
ones), with their whole texts. An id with contradicting labels is not used; of rows that repeat
an id the text of the smallest hash is taken. The bound is one of rows, at any size of the corpus; the
network has some 5,000 weights. Scoring reads every byte of every document inside the tasks, with one pass and
no shuffle.

Defined cases: a null text scores like the empty text, which has no chunk and gets the score of
all-zero features; repeated rows get equal scores; a null id counts as the text '' in the hold-out rule; without
labelled rows of both classes the network stays untrained (scores mean nothing then); other
columns pass through ``score`` (columns called ``score`` / ``predicted`` are replaced); an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline._ship import ship_by_value
from eddyline.llm.common import byte_values, map_rows

CHUNK = 512
WIDTH = 8
DIM = 8
FILTERS = 16
HIDDEN = 12
SAMPLE = 800
EPOCHS = 16
BATCH = 32
EXCERPTS = 0.4  # share of the texts shown as a short excerpt
RATE = 0.01
SEED = 20240607
FOLDS, HELD_OUT = 3, 1
BLOCK = 64  # chunks of one matrix product
STEP = CHUNK - (WIDTH - 1)
WINDOWS = CHUNK - WIDTH + 1


def chunks_of(text: bytes) -> np.ndarray:
    """All chunks of a text, zero-padded, as rows of bytes."""
    n = len(text)
    if not n:
        return np.zeros((0, CHUNK), np.uint8)
    count = 1 + max(0, -(-(n - CHUNK) // STEP))
    padded = np.zeros((count - 1) * STEP + CHUNK, np.uint8)
    padded[:n] = np.frombuffer(text, np.uint8)
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP])


class Network:
    """The weights: byte embedding, filters, and the combination."""

    def __init__(self, rng: np.random.Generator):
        self.embedding = rng.normal(0, 0.5, (256, DIM)).astype(np.float32)
        self.embedding[0] = 0  # padding
        self.filters = rng.normal(0, (2 / (WIDTH * DIM)) ** 0.5, (WIDTH * DIM, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.hidden = rng.normal(0, (2 * FILTERS + 1) ** -0.5, (2 * FILTERS + 1, HIDDEN)).astype(np.float32)
        self.hidden_bias = np.zeros(HIDDEN, np.float32)
        self.out = rng.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def load(self, weights: list[np.ndarray]) -> Network:
        for mine, given in zip(self.weights(), weights, strict=True):
            mine[...] = given
        return self

    def pooled(self, chunks: np.ndarray, where: bool = False):
        """Maxima (chunks, FILTERS) of the filters; with ``where`` also the best window."""
        best = np.zeros((len(chunks), FILTERS), np.float32)
        at = np.zeros((len(chunks), FILTERS), np.int64)
        # what a byte adds to a filter at each place of a window: the products with the embedding, made once
        given = np.einsum("bd,kdf->kbf", self.embedding, self.filters.reshape(WIDTH, DIM, FILTERS))
        for k in range(0, len(chunks), BLOCK):
            part = chunks[k : k + BLOCK]
            value = given[0][part[:, :WINDOWS]]
            for j in range(1, WIDTH):
                value += given[j][part[:, j : j + WINDOWS]]
            value += self.bias
            np.maximum(value, 0, out=value)
            if not part[:, -1].all():  # windows wholly in the padding do not count
                used = CHUNK - (part[:, ::-1] != 0).argmax(axis=1)
                value[np.arange(WINDOWS)[None, :] >= used[:, None]] = 0
            if where:
                at[k : k + BLOCK] = value.argmax(axis=1)
                best[k : k + BLOCK] = np.take_along_axis(value, at[k : k + BLOCK][:, None], axis=1)[:, 0]
            else:
                value.max(axis=1, out=best[k : k + BLOCK])
        return (best, at) if where else best

    def features(self, best: np.ndarray, chunks: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Per text (``counts`` chunks each, in order): mean and maximum of the chunks' maxima,
        and the mean fill of the chunks on a logarithmic scale."""
        out = np.zeros((len(counts), 2 * FILTERS + 1), np.float32)
        full = np.flatnonzero(counts)
        if len(full):
            starts = (np.cumsum(counts) - counts)[full]
            n = counts[full]
            out[full, :FILTERS] = np.add.reduceat(best, starts, axis=0) / n[:, None]
            out[full, FILTERS:-1] = np.maximum.reduceat(best, starts, axis=0)
            fill = np.log2(1 + np.count_nonzero(chunks, axis=1)) / np.log2(1 + CHUNK)
            out[full, -1] = np.add.reduceat(fill, starts) / n
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        parts = [chunks_of(t) for t in texts]
        counts = np.array([len(p) for p in parts], np.int64)
        chunks = np.concatenate(parts) if parts else np.zeros((0, CHUNK), np.uint8)
        return self.combined(self.features(self.pooled(chunks), chunks, counts))[1].astype(np.float64)

    def combined(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hidden layer, probability) of text features."""
        hidden = np.tanh(x @ self.hidden + self.hidden_bias)
        return hidden, 1 / (1 + np.exp(-np.clip(hidden @ self.out + self.out_bias[0], -30, 30)))


def excerpt(chunks: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A short piece of a text as a text of its own: it keeps the text's label, and lets the
    network see short texts of both classes."""
    chunk = chunks[rng.integers(len(chunks))]
    used = int(np.count_nonzero(chunk))
    size = min(used, int(np.exp(rng.uniform(np.log(12), np.log(CHUNK)))))
    at = int(rng.integers(used - size + 1))
    out = np.zeros((1, CHUNK), np.uint8)
    out[0, :size] = chunk[at : at + size]
    return out


def train(parts: list[np.ndarray], labels: np.ndarray, seed: int = SEED) -> Network:
    """Adam on the class-balanced logistic loss; ``parts``: the chunks of each text."""
    rng = np.random.default_rng(seed)
    net = Network(rng)
    if len(set(labels.tolist())) < 2:
        return net
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(parts))
        for lo in range(0, len(order), BATCH):
            rows = order[lo : lo + BATCH]
            shown = [excerpt(parts[i], rng) if rng.random() < EXCERPTS else parts[i] for i in rows]
            counts = np.array([len(x) for x in shown], np.int64)
            chunks = np.concatenate(shown)
            best, at = net.pooled(chunks, where=True)
            x = net.features(best, chunks, counts)
            h, p = net.combined(x)
            d = ((p - labels[rows]) * weight[rows] / len(rows)).astype(np.float32)
            d_hidden = d[:, None] * net.out * (1 - h * h)
            d_x = d_hidden @ net.hidden.T
            owner = np.repeat(np.arange(len(rows)), counts)
            g = d_x[owner, :FILTERS] / counts[owner, None]
            g = g + np.where(best == x[owner, FILTERS:-1], d_x[owner, FILTERS:-1], 0)
            g = np.where(best > 0, g, 0).astype(np.float32)  # (chunks, FILTERS)
            # only the best window of a chunk and filter has a gradient
            spots = at[:, :, None] + np.arange(WIDTH)[None, None, :]
            seen = chunks[np.arange(len(chunks))[:, None, None], spots]  # (chunks, FILTERS, WIDTH)
            inputs = net.embedding[seen].reshape(len(chunks), FILTERS, WIDTH * DIM)
            d_filters = np.einsum("cf,cfw->wf", g, inputs)
            back = g[:, :, None] * net.filters.T[None]  # (chunks, FILTERS, WIDTH * DIM)
            d_embedding = np.zeros_like(net.embedding)
            np.add.at(d_embedding, seen.reshape(-1), back.reshape(-1, DIM))
            d_embedding[0] = 0
            step += 1
            rate = RATE * (1 - 0.9 * epoch / EPOCHS)
            for w, dw, m, v in zip(
                net.weights(),
                [d_embedding, d_filters, g.sum(0), x.T @ d_hidden, d_hidden.sum(0), h.T @ d, d.sum(keepdims=True)],
                first, second, strict=True,
            ):
                m += 0.1 * (dw - m)
                v += 0.001 * (dw * dw - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
    return net


# ---------------------------------------------------------------- Spark


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def training_chunks(docs: DataFrame, labels: DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    """Chunks and labels of the bounded sample."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    one = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other")
    picks = []
    for label in (0, 1):
        chosen = one.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        picks += [(r["doc_id"], label) for r in chosen.select("doc_id").collect()]
    wanted = dict(picks)
    if not wanted:
        return [], np.empty(0, np.int64)
    # at most 2 * SAMPLE ids, so the texts are filtered in the scan
    found = docs.select("doc_id", "text").where(F.col("doc_id").isin(list(wanted)) & (F.col("text") != ""))
    found = found.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))
    rows = sorted(found.collect(), key=lambda r: r["doc_id"])
    return [chunks_of(r["text"].encode()) for r in rows], np.array([wanted[r["doc_id"]] for r in rows], np.int64)


def score(docs: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """``docs`` plus ``score`` and ``predicted``."""
    held = docs.sparkSession.sparkContext.broadcast(network.weights())

    def make():
        net = Network(np.random.default_rng(0)).load(held.value)

        def step(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            return {"score": pa.array(net.scores([b or b"" for b in byte_values(batch.column(text))]), pa.float64())}

        return step

    scored = map_rows(docs, make, [T.StructField("score", T.DoubleType())], by=text)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    network = train(*training_chunks(docs, labels))
    out = score(docs.select("doc_id", "text"), network)
    return out.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", "predicted")


ship_by_value(__name__)
