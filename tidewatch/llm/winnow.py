"""Document fingerprints by winnowing.

Hashes of all k-grams of code points; of each window of ``window`` consecutive hashes the smallest is
selected, the rightmost of equals, and kept with its position. Any passage of window + k - 1 code
points that two texts share has a selected hash in common.

A hash has 40 bits and shares an unsigned 64-bit word with the complement of its position, so one
running minimum of words selects the smallest hash and the rightmost position at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 25
WINDOW = 40

_POSITION_BITS = 24
_POSITIONS = (1 << _POSITION_BITS) - 1
#: code points that are hashed at a time; below the range of a position word
_CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """40-bit hashes of all k-grams: the polynomial in an odd base modulo 2**64, then mixed.

    Powers of two of grams are combined by doubling: H(2m) at i = H(m) at i times base**m plus H(m) at i + m.
    """
    value = codes.astype(np.uint64) + np.uint64(1)
    have = 1
    out, length = None, 0
    rest = gram
    while rest:
        if rest & 1:
            if out is None:
                out, length = value, have
            else:  # the longer block on the left, what is collected on its right
                n = len(codes) - length - have + 1
                out = value[:n] * _power(length) + out[have:have + n]
                length += have
        rest >>= 1
        if rest:
            n = len(value) - have
            value = value[:n] * _power(have) + value[have:]
            have *= 2
    out = out ^ (out >> np.uint64(29))
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    out = out ^ (out >> np.uint64(32))
    return out >> np.uint64(24)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def _running_min(words: np.ndarray, window: int) -> np.ndarray:
    """Minimum of every run of ``window`` words, by doubling."""
    have, low = 1, words
    while 2 * have <= window:
        low = np.minimum(low[:len(low) - have], low[have:])
        have *= 2
    gap = window - have
    return np.minimum(low[:len(low) - gap], low[gap:]) if gap else low


def select(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the selected k-grams, by position. A text shorter than k is one gram."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(codes) < gram:
        return _hashes(codes, len(codes)), np.zeros(1, np.int64)
    picked_hash, picked_at = [], []
    grams = len(codes) - gram + 1
    step = _CHUNK
    for first in range(0, max(1, grams - window + 1), step):
        # windows that begin in [first, first + step)
        hashes = _hashes(codes[first:first + step + window + gram - 2], gram)
        at = np.arange(len(hashes), dtype=np.uint64)
        words = (hashes << np.uint64(_POSITION_BITS)) | (np.uint64(_POSITIONS) - at)
        low = _running_min(words, min(window, len(words)))
        low = low[np.concatenate([[True], low[1:] != low[:-1]])]
        picked_at.append((np.uint64(_POSITIONS) - (low & np.uint64(_POSITIONS))).astype(np.int64) + first)
        picked_hash.append(low >> np.uint64(_POSITION_BITS))
    hashes, at = np.concatenate(picked_hash), np.concatenate(picked_at)
    new = np.concatenate([[True], at[1:] != at[:-1]])
    return hashes[new], at[new]


def encode(hashes: np.ndarray, positions: np.ndarray) -> str:
    """16 hex digits per selected gram: 10 of its hash, 6 of its position (modulo 2**24)."""
    words = (hashes << np.uint64(_POSITION_BITS)) | (positions & _POSITIONS).astype(np.uint64)
    return words.astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two fingerprints' distinct hashes; two empty ones are alike."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _select_rows(gram: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .common import text_slices
        for batch, raws in text_slices(batches):
            found = [select(raw.decode(), gram, window) for raw in raws]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "hashes": pa.array([h.astype(np.int64).tolist() for h, _ in found], pa.list_(pa.int64())),
                "positions": pa.array([p.tolist() for _, p in found], pa.list_(pa.int64()))})
    return run


def fingerprints(documents: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(doc_id, hashes, positions) of every whole text; null and empty texts have none.

    Positions count code points from 0. Equal texts have equal fingerprints. Repeated rows are answered
    each; other columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_select_rows(gram, window), "doc_id long, hashes array<long>, positions array<long>")


def neighbours(documents: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, rank, doc_id, text) such that each document is followed, in its bucket, by the next one.

    Order: descending doc_id, rows without one last, ties by text; after the last document comes the
    first. Buckets are ranges of the ids of about equal size. The document after a bucket's last one
    is the first of the next bucket that has any; that row is sent to both (rank 1: not to be answered).
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marks = sorted(set(rows.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 0.2 / buckets)), reverse=True)
    cut = F.array(*[F.lit(int(m)) for m in marks]) if marks else F.array().cast("array<long>")
    # the number of marks above the id; rows without an id go to the last bucket
    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(marks))).otherwise(
        F.size(F.filter(cut, lambda m: m > F.col("doc_id"))))
    placed = rows.withColumn("bucket", bucket)
    # at most one row for each of the ``buckets`` buckets: its first document
    heads = placed.groupBy("bucket").agg(F.max(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("top")).collect()
    order = sorted((r.bucket, r.top) for r in heads)
    sentinels = []
    for i, (b, top) in enumerate(order):
        into, wrap = (order[i - 1][0], 1) if i else (order[-1][0], 2)
        sentinels.append((b, top, into, wrap))
    copies = placed.where(F.lit(False)).withColumn("rank", F.lit(1))
    if sentinels:
        spark = documents.sparkSession
        wanted = spark.createDataFrame(sentinels, "bucket int, top long, into int, wrap int")
        head = placed.withColumn("top", F.coalesce("doc_id", F.lit(-(1 << 63)))).join(F.broadcast(wanted), ["bucket", "top"])
        copies = head.groupBy("into", "wrap").agg(F.min_by(F.struct("doc_id", "text"), "text").alias("d")).select(
            F.col("d.doc_id").alias("doc_id"), F.col("d.text").alias("text"), F.col("into").alias("bucket"),
            F.col("wrap").alias("rank"))
    return placed.withColumn("rank", F.lit(0)).unionByName(copies)


def _edited(gram: int, window: int):
    """mapInArrow function over rows in ``neighbours`` order: one answer per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .common import text_slices
        current = None  # (bucket, doc_id, text, hashes, positions)
        for batch, raws in text_slices(batches):
            out = {k: [] for k in ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                   "near_edited", "near_next")}
            buckets, ranks = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for bucket, rank, doc_id, raw in zip(buckets, ranks, batch.column(0).to_pylist(), raws):
                text = raw.decode()
                hashes, positions = select(text, gram, window)
                if current and current[0] == bucket:
                    _, own_id, own, own_hashes, own_positions = current
                    half = len(own) // 2
                    edited = own[:len(own) - half] + text[:half]
                    new_hashes, new_positions = select(edited, gram, window)
                    mine = np.unique(own_hashes)
                    out["doc_id"].append(own_id)
                    out["n_chars"].append(len(own))
                    out["edited_sha256"].append(hashlib.sha256(edited.encode()).hexdigest())
                    out["fingerprint"].append(encode(own_hashes, own_positions))
                    out["edited_fingerprint"].append(encode(new_hashes, new_positions))
                    out["near_edited"].append(likeness(mine, np.unique(new_hashes)))
                    out["near_next"].append(likeness(mine, np.unique(hashes)))
                current = None if rank else (bucket, doc_id, text, hashes, positions)
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(out.items(), types)})
    return run


def edited_likeness(documents: DataFrame, buckets: int, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they and the next one are.

    The edited text has its last floor(n/2) code points replaced by the first as many (or all) of the
    next document in descending doc_id. Null texts are empty; rows without a doc_id come last; equal
    doc_ids are ordered by text. A single document is its own next one. The texts are shuffled
    once, into ranges of ids; ``buckets`` bounds the number of rows that are sent twice.
    """
    rows = neighbours(documents, buckets).select("doc_id", "text", "bucket", "rank")
    sorted_rows = rows.repartition(buckets, "bucket").sortWithinPartitions(
        F.col("bucket"), F.col("rank"), F.col("doc_id").desc_nulls_last(), F.col("text"))
    return sorted_rows.mapInArrow(
        _edited(gram, window), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                               "edited_fingerprint string, near_edited double, near_next double")
