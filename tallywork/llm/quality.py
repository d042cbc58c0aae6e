"""Quality of whole texts by a byte-level convolutional network, in numpy.

A document's UTF-8 bytes are cut into overlapping chunks that cover all of it. Bytes are embedded;
filters over eight bytes slide over each chunk byte by byte and are max-pooled, so a chunk says how strongly
each filter answers anywhere in it. The mean over the chunks goes through a small hidden layer to
one probability. Only the winning position of a filter has a gradient, so training is cheap."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallywork.llm.common import text_of
from tallywork.llm.labelled import fold, sample

#: Bounds of the training sample: documents per label, and chunks of a document (28 kB of text; of a
#: longer one so many of its chunks, chosen by their hash). The driver holds no more than these.
DOCS_PER_LABEL, TRAINING_CHUNKS = 2500, 64
CHUNK, OVERLAP = 512, 64
WIDTH = 8
BYTE_DIM, FILTERS, HIDDEN = 8, 32, 16
EPOCHS, BATCH, RATE = 8, 50, 4e-3
THRESHOLD = 0.3
#: Chunks that go through the filters together.
TOGETHER = 256


def chunks(raw: bytes) -> np.ndarray:
    """(n, CHUNK) bytes, the last chunk filled up with zeros; one empty chunk for no bytes."""
    hop = CHUNK - OVERLAP
    n = max(1, -(-(len(raw) - OVERLAP) // hop))
    filled = np.zeros((n - 1) * hop + CHUNK, np.uint8)
    filled[: len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(filled, CHUNK)[::hop]


class Network:
    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        shapes = {
            "bytes": (256, BYTE_DIM), "filters": (WIDTH * BYTE_DIM, FILTERS), "shift": (FILTERS,),
            "hidden": (FILTERS, HIDDEN), "hidden_shift": (HIDDEN,), "out": (HIDDEN,), "out_shift": (),
        }
        scale = {"bytes": 0.5, "filters": 1 / np.sqrt(WIDTH * BYTE_DIM), "hidden": 1 / np.sqrt(FILTERS), "out": 1 / np.sqrt(HIDDEN)}
        self.p = {k: (r.standard_normal(s) * scale.get(k, 0.0)).astype(np.float32) for k, s in shapes.items()}
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.steps = 0

    def pooled(self, some: np.ndarray, where: bool = False):
        """The largest answer of each filter in each chunk, and where it was."""
        half = WIDTH // 2 * BYTE_DIM
        embedded = self.p["bytes"][some]
        both = np.concatenate([self.p["filters"][:half], self.p["filters"][half:]], axis=1)
        top, place = None, None
        for shift in range(WIDTH // 2):  # blocks of half a window, from each of their alignments
            blocks = (CHUNK - shift) // (WIDTH // 2)
            groups = embedded[:, shift : shift + blocks * (WIDTH // 2)].reshape(-1, half)
            parts = (groups @ both).reshape(len(some), blocks, 2 * FILTERS)
            answers = parts[:, :-1, :FILTERS] + parts[:, 1:, FILTERS:]
            best = answers.max(axis=1)
            if where:
                at = answers.argmax(axis=1) * (WIDTH // 2) + shift
                place = at if top is None else np.where(best > top, at, place)
            top = best if top is None else np.maximum(top, best)
        top = top + self.p["shift"]
        return (top, place) if where else top

    def head(self, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(mean @ self.p["hidden"] + self.p["hidden_shift"])
        return hidden, 1 / (1 + np.exp(-np.clip(hidden @ self.p["out"] + self.p["out_shift"], -30, 30)))

    def probability(self, text: str) -> float:
        raw = text.encode("utf-8", "replace")
        if not raw:
            return 0.0
        all_chunks, total = chunks(raw), np.zeros(FILTERS, np.float64)
        for a in range(0, len(all_chunks), TOGETHER):
            total += np.maximum(self.pooled(all_chunks[a : a + TOGETHER]), 0).sum(axis=0)
        return float(self.head((total / len(all_chunks)).astype(np.float32))[1])

    def probabilities(self, texts: list[str]) -> list[float]:
        """As ``probability``, short texts in one pass."""
        out: list[float] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> None:
            if held:
                answers = np.maximum(self.pooled(np.concatenate(held)), 0)
                starts = np.cumsum([0] + [len(h) for h in held[:-1]])
                means = np.add.reduceat(answers, starts, axis=0) / np.array([[len(h)] for h in held], np.float32)
                out.extend(self.head(means)[1].astype(float).tolist())
                held.clear()

        for text in texts:
            if not text or len(text) > CHUNK * TOGETHER // 4:
                flush()
                size = 0
                out.append(self.probability(text))
                continue
            held.append(chunks(text.encode("utf-8", "replace")))
            size += len(held[-1])
            if size >= TOGETHER:
                flush()
                size = 0
        flush()
        return out

    def learn(self, docs: list[np.ndarray], labels: np.ndarray) -> None:
        """One step of Adam on the chunks of some documents."""
        counts = np.array([len(d) for d in docs])
        owner = np.repeat(np.arange(len(docs)), counts)
        some = np.concatenate(docs)
        top, where = self.pooled(some, True)
        live = np.maximum(top, 0)
        mean = np.add.reduceat(live, np.cumsum([0, *counts[:-1]]), axis=0) / counts[:, None].astype(np.float32)
        hidden, p = self.head(mean)
        d_out = ((p - labels) / len(docs)).astype(np.float32)
        d_hidden = np.outer(d_out, self.p["out"]) * (1 - hidden**2)
        d_mean = d_hidden @ self.p["hidden"].T
        d_top = (d_mean / counts[:, None].astype(np.float32))[owner] * (top > 0)
        spans = where[:, :, None] + np.arange(WIDTH)  # chunk, filter, byte of the winning window
        codes = np.take_along_axis(some[:, None, :], spans, axis=2)
        windows = self.p["bytes"][codes].reshape(len(some), FILTERS, -1)
        grads = {
            "out": hidden.T @ d_out, "out_shift": d_out.sum(), "hidden": mean.T @ d_hidden, "hidden_shift": d_hidden.sum(axis=0),
            "shift": d_top.sum(axis=0), "filters": np.einsum("cf,cfw->wf", d_top, windows),
        }
        back = d_top[:, :, None] * self.p["filters"].T[None]
        flat = back.reshape(-1, BYTE_DIM)
        grads["bytes"] = np.stack([np.bincount(codes.ravel(), flat[:, i], 256) for i in range(BYTE_DIM)], axis=1)
        self.steps += 1
        for k, g in grads.items():
            m, v = self.moments[k]
            g = np.asarray(g, np.float32)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            self.moments[k] = (m, v)
            step = m / (1 - 0.9**self.steps) / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8)
            self.p[k] = (self.p[k] - RATE * step).astype(np.float32)


def training_chunks(raw: bytes) -> np.ndarray:
    """All chunks of a text, or TRAINING_CHUNKS of them by their hash."""
    found = chunks(raw)
    if len(found) <= TRAINING_CHUNKS:
        return np.ascontiguousarray(found)
    by_hash = np.argsort([zlib.crc32(b"%d:" % i + c.tobytes()) for i, c in enumerate(found)], kind="stable")
    return np.ascontiguousarray(found[np.sort(by_hash[:TRAINING_CHUNKS])])


def cut(texts: DataFrame) -> DataFrame:
    """(chunks, label) of labelled texts: what training takes of each, in one binary."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                raw = text.as_py().encode("utf-8", "replace")
                if raw:
                    yield pa.RecordBatch.from_arrays([pa.array([training_chunks(raw).tobytes()], pa.binary()), pa.array([label.as_py()], pa.int32())], names=["chunks", "label"])

    return texts.select("text", "label").mapInArrow(each, "chunks binary, label int")


def fit(rows: list[tuple[bytes, int]], epochs: int = EPOCHS) -> Network | None:
    """A network from (chunks, label); None without texts of both labels. Labels weigh alike."""
    rows = sorted((bytes(found), label) for found, label in rows)
    if len({label for _, label in rows}) < 2:
        return None
    r = np.random.default_rng(5)
    by_label = [[np.frombuffer(found, np.uint8).reshape(-1, CHUNK) for found, label in rows if label == y] for y in (0, 1)]
    network = Network()
    per_epoch = max(1, min(len(by_label[0]) + len(by_label[1]), 2 * DOCS_PER_LABEL) // BATCH)
    for _ in range(epochs * max(1, 60 // per_epoch)):
        for _ in range(per_epoch):
            docs, labels = [], []
            for y in (0, 1):
                for at in r.integers(0, len(by_label[y]), BATCH // 2):
                    docs.append(by_label[y][at])
                    labels.append(y)
            network.learn(docs, np.array(labels, np.float32))
    network.moments = {}
    return network


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per document: doc_id, held_out, score, predicted.

    Only texts are inputs of a score. Fits on labelled rows whose fold of five is not 0, at most
    DOCS_PER_LABEL of each label and TRAINING_CHUNKS of a text. Null and empty texts score 0; without usable labels all others
    score 0.5. Rows that repeat come back as often; ids may be null. Other columns are not read;
    an empty table gives no rows."""
    texts = sample(docs, labels, "quality", fold("doc_id", 5) != 0, {0: DOCS_PER_LABEL, 1: DOCS_PER_LABEL})
    network = fit([(r["chunks"], r["label"]) for r in cut(texts).toLocalIterator()])
    source = docs.select("doc_id", text_of().alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                texts = [str(x) for x in part.column(1)]
                found = network.probabilities(texts) if network else [0.5 if t else 0.0 for t in texts]
                predicted = [int(s >= THRESHOLD) for s in found]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64()), pa.array(predicted, pa.int32())], names=schema.names)

    return source.mapInArrow(score, schema).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
