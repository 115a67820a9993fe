"""Quality classifier: a convolutional network over the bytes of whole texts.

A text is cut into overlapping chunks that cover all of it. Learned filters run over each chunk's embedded
bytes and keep their strongest answer; the mean, the maximum and the minimum of the chunks' answers go into
one logistic unit. Training happens on the driver, on a sample of labelled rows whose size has a bound;
scoring is a column function with the few thousand weights in its closure.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.staging import stage
from tidemark.llm.words import texts

CHUNK, STEP = 256, 192
WIDTH, STRIDE = 6, 2
DIMS, FILTERS = 8, 24
EPOCHS, BATCH, RATE = 8, 32, 0.01

#: Bounds of the training sample: documents of each class, bytes of text altogether (half for each class), and of one text.
SAMPLE_DOCS = 1500
SAMPLE_BYTES = 12_000_000
TEXT_BYTES = 1_000_000

#: Chunks scored at a time.
BLOCK = 1024
THRESHOLD = 0.7
HELD_OUT = 2
FOLDS = 4


def fold(doc_id: str) -> Column:
    """crc32 of the id as text, modulo four; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def chunks(text: bytes) -> np.ndarray:
    """(chunks, CHUNK) bytes; the last is filled up with zeros. An empty text is one chunk of zeros."""
    n = max(1, -(-(len(text) - CHUNK) // STEP) + 1)
    padded = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    padded[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


class Model:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bytes = (rng.normal(size=(256, DIMS)) * 0.5).astype(np.float32)
        self.filters = (rng.normal(size=(WIDTH * DIMS, FILTERS)) * (2 / (WIDTH * DIMS)) ** 0.5).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.head = (rng.normal(size=3 * FILTERS) * 0.05).astype(np.float32)
        self.offset = np.zeros(1, np.float32)
        self.constant: float | None = None

    def weights(self) -> list[np.ndarray]:
        return [self.bytes, self.filters, self.bias, self.head, self.offset]

    def pooled(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(chunks, FILTERS) strongest answers, and the positions that gave them."""
        embedded = self.bytes[pieces]
        windows = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH, axis=1)[:, ::STRIDE]
        flat = np.ascontiguousarray(windows.transpose(0, 1, 3, 2)).reshape(-1, WIDTH * DIMS)
        answers = (flat @ self.filters).reshape(len(pieces), -1, FILTERS)
        at = answers.argmax(axis=1)
        strongest = np.take_along_axis(answers, at[:, None], axis=1)[:, 0]
        return np.maximum(strongest + self.bias, 0), at

    def features(self, pooled: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        mean = np.add.reduceat(pooled, starts) / sizes[:, None]
        return np.concatenate((mean, np.maximum.reduceat(pooled, starts), np.minimum.reduceat(pooled, starts)), axis=1)

    def score(self, bodies: list[bytes]) -> np.ndarray:
        """Probability of label 1 for each text."""
        if self.constant is not None or not bodies:
            return np.full(len(bodies), self.constant or 0.0)
        found, first = [], 0
        while first < len(bodies):
            cut, size, last = [], 0, first
            while last < len(bodies) and (size < BLOCK or last == first):
                cut.append(chunks(bodies[last]))
                size, last = size + len(cut[-1]), last + 1
            sizes = np.array([len(c) for c in cut])
            # A very long text has many chunks: answers are made block by block, however long it is.
            answers = np.concatenate(
                [self.pooled(part[i:i + BLOCK])[0] for part in [np.concatenate(cut)] for i in range(0, size, BLOCK)]
            )
            rows = self.features(answers, np.cumsum(sizes) - sizes, sizes)
            found.append(1 / (1 + np.exp(-(rows @ self.head + self.offset).astype(np.float64))))
            first = last
        return np.concatenate(found)

    def _gradients(self, bodies: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
        pieces = np.concatenate(bodies)
        sizes = np.array([len(c) for c in bodies])
        starts, of = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
        pooled, at = self.pooled(pieces)
        rows = self.features(pooled, starts, sizes)
        error = (1 / (1 + np.exp(-(rows @ self.head + self.offset))) - labels) * weights / len(labels)
        per_row = error[:, None] * self.head
        mean, top, low = per_row[:, :FILTERS], per_row[:, FILTERS:2 * FILTERS], per_row[:, 2 * FILTERS:]
        back = (mean / sizes[:, None])[of]
        for part, best in ((top, rows[:, FILTERS:2 * FILTERS]), (low, rows[:, 2 * FILTERS:])):
            hit = pooled == best[of]
            back = back + hit * (part / np.maximum(np.add.reduceat(hit, starts, dtype=np.float32), 1))[of]
        back = back * (pooled > 0)
        # Only the strongest position of each chunk and filter has a gradient.
        taps = pieces[np.arange(len(pieces))[:, None, None], at[:, :, None] * STRIDE + np.arange(WIDTH)]
        patches = self.bytes[taps].reshape(len(pieces), FILTERS, WIDTH * DIMS)
        filters = np.einsum("cf,cfk->kf", back, patches, optimize=True)
        to_bytes = back[:, :, None] * self.filters.T[None]
        to_bytes = to_bytes.reshape(-1, DIMS)
        embedded = np.stack([np.bincount(taps.ravel(), to_bytes[:, d], 256) for d in range(DIMS)], axis=1)
        return [embedded, filters, back.sum(axis=0), rows.T @ error, error.sum(keepdims=True)]

    def fit(self, bodies: list[bytes], labels: np.ndarray, weights: np.ndarray, seed: int = 11) -> "Model":
        """Adam over all chunks of all sampled texts. Texts of one label only give a constant score."""
        if len(set(labels.tolist())) < 2:
            self.constant = float(labels[0]) if len(labels) else 1.0
            return self
        rng, cut = np.random.default_rng(seed), [chunks(b) for b in bodies]
        state = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights()]
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(cut))
            for first in range(0, len(order), BATCH):
                chosen = order[first:first + BATCH]
                step += 1
                rate = RATE * (1 - epoch / EPOCHS) * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                for w, g, (m, v) in zip(
                    self.weights(), self._gradients([cut[i] for i in chosen], labels[chosen], weights[chosen]), state
                ):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
        return self


def within(sizes: list[tuple[int, int]], bound: int) -> list[int]:
    """Positions in ``sizes`` (label, bytes), in order, of the texts kept: a text that no longer fits its class's half is passed over."""
    kept, used = [], {0: 0, 1: 0}
    for i, (label, size) in enumerate(sizes):
        if used[label] + size <= bound // 2:
            used[label] += size
            kept.append(i)
    return kept


def training_rows(docs: DataFrame, labels: DataFrame) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts, labels and weights of the sample, from rows of ``docs`` that are labelled and not held out.

    A document whose label rows disagree or are null is left out, and so are labels of documents that ``docs`` lacks
    and texts above ``TEXT_BYTES``; of several rows with one id the least text counts. Each class gives its first
    ``SAMPLE_DOCS`` documents in the order of a hash of the id, as far as they fit half of ``SAMPLE_BYTES``. The weights
    bring the classes back to their shares among all labelled documents of ``docs``.
    """
    body = F.coalesce("text", F.lit(""))
    usable = docs.where(F.octet_length(body) <= TEXT_BYTES)
    voted = stage(
        labels.where("quality in (0, 1) and doc_id is not null").where(fold("doc_id") != HELD_OUT)
        .groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
        .where("label = other").select("doc_id", "label")
        .join(usable.select("doc_id"), "doc_id", "left_semi"),
        "labelled",
    )
    held = {r["label"]: r["count"] for r in voted.groupBy("label").count().collect()}  # two rows at most
    order = F.xxhash64("doc_id")
    sampled = None
    for label in (0, 1):
        part = voted.where(F.col("label") == label).orderBy(order, "doc_id").limit(SAMPLE_DOCS)
        sampled = part if sampled is None else sampled.unionAll(part)
    # At most 2 x SAMPLE_DOCS ids: small enough to send to every task that reads texts. The texts are written
    # where they are, so that only their sizes are known to the driver when it chooses.
    rows = stage(
        usable.select("doc_id", body.alias("text")).join(F.broadcast(sampled), "doc_id")
        .groupBy("doc_id", "label").agg(F.min("text").alias("text"))
        .select("doc_id", "label", "text", order.alias("o")),
        "sample",
    )
    sizes = rows.select("doc_id", "label", F.octet_length("text").alias("size")).orderBy("o", "doc_id").collect()
    chosen = [sizes[i]["doc_id"] for i in within([(r["label"], r["size"]) for r in sizes], SAMPLE_BYTES)]
    ids = docs.sparkSession.createDataFrame([(x,) for x in chosen], T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType)]))
    found = rows.join(F.broadcast(ids), "doc_id").orderBy("o", "doc_id").select("label", "text").collect()  # SAMPLE_BYTES at most
    y = np.array([r["label"] for r in found], np.float32)
    weights = np.ones(len(y), np.float32)
    for label in (0, 1):
        if (y == label).any():
            share = held[label] / sum(held.values())
            weights[y == label] = share * len(y) / (y == label).sum()
    return [r["text"].encode() for r in found], y, weights


def train(docs: DataFrame, labels: DataFrame) -> Model:
    return Model().fit(*training_rows(docs, labels))


def scored_by(model: Model, text: str) -> Column:
    """The score of each whole text; null counts as empty."""

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(model.score(texts(batch)), pa.float64())

    return score(text)


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    rows = docs.select("doc_id", (fold("doc_id") == HELD_OUT).alias("held_out"), scored_by(model, "text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
