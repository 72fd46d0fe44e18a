"""Language identification with hyperdimensional profiles.

Letters get fixed random +1/-1 vectors. An n-gram's vector binds its letters' vectors, the j-th one
rotated n-1-j times, by elementwise product; a text's vector bundles (adds up) its n-grams' vectors; a
language's prototype bundles its training texts. Texts are compared with prototypes by cosine.

Bundling is linear, so a text's vector is (n-gram counts) x (n-gram vectors): a task counts the n-grams of
its texts and gets all text vectors with one matrix product. Training adds up n-gram counts per
language over all training rows; the result is bounded by languages x ``SYMBOLS**n`` numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NGRAM = 3
DIMENSION = 1024
#: word boundary, 26 ASCII letters and classes of other letters
SYMBOLS = 40
SEED = 7
UNDETERMINED = "und"

#: rows of a matrix product
_ROWS = 128


@lru_cache(maxsize=1)
def _symbol_table() -> np.ndarray:
    """Code point -> symbol: 0 for anything but a letter, 1..26 for a-z, then classes of other letters."""
    table = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        if not 0xD800 <= cp < 0xE000 and chr(cp).isalpha():
            low = chr(cp).lower()
            low = ord(low) if len(low) == 1 else cp
            table[cp] = low - 96 if 97 <= low <= 122 else 27 + low % (SYMBOLS - 27)
    return table


def symbols_of(text: str) -> np.ndarray:
    """Symbols of a text: letters, with each run of other characters as one boundary, and one at each end."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    found = _symbol_table()[codes]
    keep = found > 0
    keep[1:] |= found[:-1] > 0
    return np.concatenate([[0], found[keep], [0]]).astype(np.int32) if found.any() else np.zeros(0, np.int32)


def ngram_counts(text: str, n: int = NGRAM) -> tuple[np.ndarray, np.ndarray] | None:
    """(n-grams of the text, ascending, as numbers below ``SYMBOLS**n``; their counts); None for a text without letters."""
    s = symbols_of(text)
    if not len(s):
        return None
    gram = np.zeros(max(0, len(s) - n + 1), np.int32)
    for j in range(n):
        gram = gram * SYMBOLS + s[j:len(s) - n + 1 + j]
    counts = np.bincount(gram)
    used = np.flatnonzero(counts)
    return used, counts[used]


def ngram_vectors(grams: np.ndarray, n: int, dimension: int, seed: int) -> np.ndarray:
    """Bound vectors of the n-grams with these numbers, one row each."""
    letters = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (SYMBOLS, dimension))
    out = np.ones((len(grams), dimension), np.int8)
    for j in range(n):
        turned = np.roll(letters, n - 1 - j, axis=1)
        out *= turned[(grams // SYMBOLS ** (n - 1 - j)) % SYMBOLS]
    return out


class Profiles:
    """Prototypes of the learned languages, unit length, and the n-gram vectors in use."""

    def __init__(self, counts: dict[str, np.ndarray], n: int, dimension: int, seed: int):
        self.n, self.dimension, self.seed = n, dimension, seed
        self.languages = sorted(counts)
        self.prototypes = np.zeros((len(self.languages), dimension), np.float32)
        for k, name in enumerate(self.languages):
            total = counts[name].astype(np.float64)
            for i in range(0, len(total), 4096):
                used = np.flatnonzero(total[i:i + 4096]) + i
                if len(used):
                    self.prototypes[k] += total[used] @ ngram_vectors(used, n, dimension, seed)
            self.prototypes[k] /= max(np.linalg.norm(self.prototypes[k]), 1e-12)

    def vectors(self) -> np.ndarray:
        """The vectors of all n-grams, built once per Python worker (SYMBOLS**n x dimension bytes)."""
        return _all_vectors(self.n, self.dimension, self.seed)

    def cosines(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Cosine of each text (its n-gram counts) with each prototype, one row each."""
        used = np.unique(np.concatenate([grams for grams, _ in texts]))
        counts = np.zeros((len(texts), len(used)), np.float32)
        for row, (grams, n) in zip(counts, texts):
            row[np.searchsorted(used, grams)] = n
        texts = counts @ self.vectors()[used].astype(np.float32)
        norm = np.linalg.norm(texts, axis=1, keepdims=True)
        return (texts @ self.prototypes.T) / np.maximum(norm, 1e-12)


@lru_cache(maxsize=2)
def _all_vectors(n: int, dimension: int, seed: int) -> np.ndarray:
    return ngram_vectors(np.arange(SYMBOLS ** n), n, dimension, seed)


def _count(n: int):
    """mapInArrow function: n-gram counts per language over the rows of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .common import text_slices
        totals: dict[str, np.ndarray] = {}
        for batch, raws in text_slices(batches):
            for name, raw in zip(batch.column(0).to_pylist(), raws):
                counts = ngram_counts(raw.decode(), n)
                if counts is not None:
                    totals.setdefault(name, np.zeros(SYMBOLS ** n, np.int64))[counts[0]] += counts[1]
        for name, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * len(used), pa.string()), "gram": pa.array(used, pa.int64()),
                "n": pa.array(total[used], pa.int64())})
    return run


def fit(documents: DataFrame, n: int = NGRAM, dimension: int = DIMENSION, seed: int = SEED) -> Profiles:
    """Profiles of the languages in ``lang``, from all rows with text and non-null ``lang``.

    What reaches the driver is at most languages x ``SYMBOLS**n`` counts, whatever the number of rows.
    Without any training row there are no languages and every prediction is ``und``.
    """
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sums = rows.mapInArrow(_count(n), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts: dict[str, np.ndarray] = {}
    for row in sums.toLocalIterator():
        counts.setdefault(row.lang, np.zeros(SYMBOLS ** n, np.int64))[row.gram] = row.n
    return Profiles(counts, n, dimension, seed)


def _predict_rows(profiles: Profiles, texts: list[str]) -> tuple[list[str], list[float]]:
    langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    for i in range(0, len(texts), _ROWS):
        rows = [(k, c) for k in range(i, min(i + _ROWS, len(texts)))
                if (c := ngram_counts(texts[k], profiles.n)) is not None]
        if rows and profiles.languages:
            cosine = profiles.cosines([c for _, c in rows])
            best = cosine.argmax(axis=1)
            for (k, _), j, row in zip(rows, best, cosine):
                langs[k], scores[k] = profiles.languages[j], float(min(1.0, max(0.0, row[j])))
    return langs, scores


def predict(documents: DataFrame, profiles: Profiles) -> DataFrame:
    """(doc_id, lang_pred, score) of every row.

    ``lang_pred`` is the language with the largest cosine (the alphabetically first of equals), ``score``
    that cosine, cut at 0. A null text, or one without a letter, is ``und`` with score 0.
    Repeated rows get equal answers; other columns are ignored.
    """
    model = documents.sparkSession.sparkContext.broadcast(profiles)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .common import text_slices
        for batch, raws in text_slices(batches):
            langs, scores = _predict_rows(model.value, [raw.decode() for raw in raws])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "lang_pred": pa.array(langs, pa.string()),
                                              "score": pa.array(scores, pa.float64())})
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(documents: DataFrame, profiles: Profiles, min_score: float = 0.0) -> DataFrame:
    """The rows whose language is determined with at least ``min_score``, all columns unchanged.

    With the default, only rows without text or without a letter go, whatever the language and its score. If no
    language was learned, none can be determined, and all rows with a letter are kept.
    """
    model = documents.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .common import text_slices
        for batch, raws in text_slices(batches):
            texts = [raw.decode() for raw in raws]
            if model.value.languages:
                kept = [a != UNDETERMINED and s >= min_score for a, s in zip(*_predict_rows(model.value, texts))]
            else:
                kept = [ngram_counts(text, model.value.n) is not None for text in texts]
            yield batch.filter(pa.array(kept, pa.bool_()))
    return documents.mapInArrow(run, documents.schema)
