"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages (runs of ``PASSAGE`` bytes of its whole text). Each passage is encoded
by counts of its characters' classes, letter trigrams and repetition, followed by a learned layer.
A gated attention weighs the passages of a document, learned from document labels alone, and the
weighted sum of the encodings is scored.

Scoring is one pass over the texts. The model is fitted on a bounded sample of the labelled rows:
``max_documents`` rows with the smallest hash of their id, and at most ``max_passages`` passages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PASSAGE = 1024
MAX_DOCUMENTS = 8000
MAX_PASSAGES = 60_000
THRESHOLD = 0.3

_TRIGRAMS = 256
_REPEAT_BINS = 1024
_HIDDEN, _GATE = 48, 16


def _byte_classes() -> np.ndarray:
    table = np.full(256, 11, np.uint8)  # other ASCII punctuation and control characters
    groups = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",;:",
              b"!?", b"|<>{}[]()=", b"#$%&*@", bytes(range(128, 256))]
    for k, group in enumerate(groups):
        table[list(group)] = k
    return table


_CLASS = _byte_classes()
_CLASSES = 12
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
FEATURES = _CLASSES * _CLASSES + _TRIGRAMS + 6


def encode_passages(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, number of passages of each text); an empty text is one empty passage."""
    sizes = np.array([len(r) for r in raws], np.int64)
    counts = np.maximum(1, -(-sizes // PASSAGE))
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    codes = np.frombuffer(b"".join(raws), np.uint8)
    start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    inside = np.arange(len(codes)) - np.repeat(start, sizes)
    passage = np.repeat(first, sizes) + inside // PASSAGE
    total = int(counts.sum())
    length = np.bincount(passage, minlength=total).astype(np.float32)
    scale = 1 / np.maximum(length, 1)[:, None]

    def histogram(values: np.ndarray, bins: int, span: int) -> np.ndarray:
        """Per passage, of values that each describe ``span`` bytes from their place on."""
        at = passage[:len(values)]
        whole = at == passage[span - 1:span - 1 + len(values)]
        key = at[whole] * bins + values[whole]
        return np.bincount(key, minlength=total * bins).reshape(total, bins).astype(np.float32)

    kind = _CLASS[codes].astype(np.int64)
    pairs = histogram(kind[:-1] * _CLASSES + kind[1:], _CLASSES ** 2, 2) * scale
    low = _FOLD[codes]
    three = (low[:-2] * np.uint32(0x9E3779B1) + low[1:-1] * np.uint32(0x85EBCA77) + low[2:] * np.uint32(0xC2B2AE3D))
    grams = np.sqrt(histogram((three >> np.uint32(24)).astype(np.int64), _TRIGRAMS, 3) * scale)
    six = three[:-3] * np.uint32(0x27D4EB2F) + (three[3:] ^ (three[3:] >> np.uint32(15)))
    spread = histogram(((six ^ (six >> np.uint32(13))) >> np.uint32(8)).astype(np.int64) % _REPEAT_BINS, _REPEAT_BINS, 6)
    n = np.maximum(spread.sum(axis=1), 1)
    repeat = np.stack([(spread ** 2).sum(axis=1) / n ** 2, spread.max(axis=1) / n, (spread > 0).sum(axis=1) / n], axis=1)
    words = pairs.reshape(total, _CLASSES, _CLASSES)[:, :, 3].sum(axis=1)
    extra = np.stack([length / PASSAGE, words, np.log1p(np.repeat(sizes, counts)) / 10], axis=1)
    return np.concatenate([pairs, grams, repeat, extra], axis=1).astype(np.float32), counts


def _by_document(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first, axis=0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class AttentionModel:
    """Gated-attention multiple-instance model: ``p`` holds its weight matrices."""

    mean: np.ndarray
    spread: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        p, bag = self.p, np.repeat(np.arange(len(counts)), counts)
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a = e / _by_document(e, first)[bag]
        z = _by_document(a[:, None] * h, first)
        return {"first": first, "bag": bag, "h": h, "t": t, "g": g, "a": a, "z": z, "score": _sigmoid(z @ p["u"] + p["c"])}

    def scaled(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.spread, -8, 8)

    def score(self, raws: list[bytes]) -> np.ndarray:
        features, counts = encode_passages(raws)
        return self.forward(self.scaled(features), counts)["score"]

    def gradients(self, x: np.ndarray, f: dict[str, np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
        p, bag, h, t, g, a = self.p, f["bag"], f["h"], f["t"], f["g"], f["a"]
        d_logit = (f["score"] - y) / len(y)
        d_z = d_logit[:, None] * p["u"]
        d_a = (d_z[bag] * h).sum(axis=1)
        d_e = a * (d_a - _by_document(a * d_a, f["first"])[bag])
        d_t, d_g = d_e[:, None] * p["w"] * g * (1 - t * t), d_e[:, None] * p["w"] * t * g * (1 - g)
        d_h = (a[:, None] * d_z[bag] + d_t @ p["V"].T + d_g @ p["U"].T) * (1 - h * h)
        return {"u": f["z"].T @ d_logit, "c": d_logit.sum(keepdims=True), "w": (t * g).T @ d_e, "V": h.T @ d_t,
                "U": h.T @ d_g, "W": x.T @ d_h, "b": d_h.sum(axis=0)}


def train(features: np.ndarray, counts: np.ndarray, labels: np.ndarray, epochs: int = 25, batch: int = 64,
          rate: float = 2e-3, decay: float = 1e-4, seed: int = 11) -> AttentionModel:
    """Fit by Adam on the mean log loss of the documents' labels."""
    rng = np.random.default_rng(seed)
    mean, spread = features.mean(axis=0), features.std(axis=0) + 1e-3
    shape = {"W": (features.shape[1], _HIDDEN), "b": (_HIDDEN,), "V": (_HIDDEN, _GATE), "U": (_HIDDEN, _GATE),
             "w": (_GATE,), "u": (_HIDDEN,), "c": (1,)}
    p = {k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if k not in "bc" else np.zeros(s)).astype(np.float32)
         for k, s in shape.items()}
    model = AttentionModel(mean, spread, p)
    x, first = model.scaled(features), np.concatenate([[0], np.cumsum(counts)[:-1]])
    m, v, step = {k: 0.0 for k in p}, {k: 0.0 for k in p}, 0
    for _ in range(epochs):
        order = rng.permutation(len(counts))
        for i in range(0, len(order), batch):
            docs = order[i:i + batch]
            rows = np.concatenate([np.arange(first[d], first[d] + counts[d]) for d in docs])
            grads = model.gradients(x[rows], model.forward(x[rows], counts[docs]), labels[docs])
            step += 1
            for k, grad in grads.items():
                grad = grad + decay * p[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * grad, 0.999 * v[k] + 0.001 * grad * grad
                rise = m[k] / (1 - 0.9 ** step) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
                p[k] -= (rate * rise).astype(np.float32)
    return model


def _encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from .common import text_slices
    for batch, raws in text_slices(batches):
        features, counts = encode_passages(raws)
        ends = np.cumsum(counts)
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "label": batch.column(1), "passages": pa.array(counts, pa.int64()),
            "features": pa.array([features[e - c:e].tobytes() for e, c in zip(ends, counts)], pa.binary())})


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", max_documents: int = MAX_DOCUMENTS,
        max_passages: int = MAX_PASSAGES) -> AttentionModel:
    """Fit on the documents of at most ``max_documents`` labelled ids, taken in the order of a hash of the id.

    Rows of ``labels`` with a null id or label are left out; ids with contradicting labels are used
    once per label. With no labelled document, or only one class, the model scores every text with
    the share of label 1 (0.5 without any).
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label")).dropna()
    sample = known.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_documents)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most max_documents rows of two numbers
    encoded = (rows.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
               .mapInArrow(_encode_rows, "doc_id long, label double, passages long, features binary")
               .orderBy(F.xxhash64("doc_id"), "doc_id", "label", "features").limit(max_documents))
    parts, counts, answers = [], [], []
    for row in encoded.toLocalIterator():
        if sum(counts) + row.passages > max_passages:
            continue
        parts.append(np.frombuffer(bytes(row.features), np.float32).reshape(-1, FEATURES))
        counts.append(row.passages)
        answers.append(row.label)
    y = np.array(answers, np.float32)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        flat = {"W": np.zeros((FEATURES, 1), np.float32), "b": np.zeros(1, np.float32), "V": np.zeros((1, 1), np.float32),
                "U": np.zeros((1, 1), np.float32), "w": np.zeros(1, np.float32), "u": np.zeros(1, np.float32),
                "c": np.array([np.log(share / (1 - share))], np.float32)}
        return AttentionModel(np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32), flat)
    return train(np.concatenate(parts), np.array(counts), y)


def score(documents: DataFrame, model: AttentionModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every whole text; null and empty texts are one empty passage.

    Repeated rows get equal scores; other columns are ignored.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .common import text_slices
        for batch, raws in text_slices(batches):
            found = shared.value.score(raws).astype(np.float64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "score": pa.array(found, pa.float64()),
                                              "predicted": pa.array((found >= threshold).astype(np.int32), pa.int32())})
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")
