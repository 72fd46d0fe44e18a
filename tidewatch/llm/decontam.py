"""Benchmark decontamination with a document-partitioned positional inverted index.

Every task builds, for the documents it holds, the posting lists (term -> ascending word positions)
of the benchmark's terms. A 13-word window is answered from those lists alone: starting with the
window's shortest list, each list is shifted back by its term's offset and intersected with what is
left; what remains are the starts of exact phrase matches. Index and postings stay where the
documents are, so nothing of the corpus is shuffled.

The benchmark is the stated query set. It is sent to the tasks in blocks of at most
``block_bytes`` of text; each block is one pass through the same tasks, carrying the matches found
so far along with the row, so a benchmark of any size is answered with bounded broadcasts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import unused

#: longest window in words; an item of fewer words is one window
WINDOW = 13

#: text bytes of the benchmark that are broadcast at a time
BLOCK_BYTES = 16 << 20

# A-Z to a-z; every other ASCII character that is not a letter or digit separates words
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or b >= 97 and b <= 122 or b >= 128 else 32
               for b in range(256))

_MATCHES = "array<struct<start:long,length:int,item:string,kind:string>>"
_MATCH_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int32()),
                                  ("item", pa.string()), ("kind", pa.string())]))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_WORDS).split()


class QueryBlock:
    """The windows of some benchmark items over one shared vocabulary."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.items = [name for name, _ in items]
        self.vocab: dict[bytes, int] = {}
        groups: dict[int, dict[tuple[int, ...], set[int]]] = {}
        ids_of = []
        for k, (_, raw) in enumerate(items):
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words_of(raw)]
            ids_of.append(ids)
            n = min(window, len(ids))
            for s in range(len(ids) - n + 1 if n else 0):
                groups.setdefault(n, {}).setdefault(tuple(ids[s:s + n]), set()).add(k)
        # equal windows of several items are searched once
        self.windows = [(n, np.array(list(by), dtype=np.int32), [sorted(v) for v in by.values()])
                        for n, by in sorted(groups.items())]
        seen = np.zeros(len(self.vocab), dtype=np.int64)
        for ids in ids_of:
            seen[list(set(ids))] += 1
        names = {i: w for w, i in self.vocab.items()}
        # proximity: the term in the fewest items leads, the longer and then the smaller word first among equals
        self.bags = [(k, len(ids), sorted(set(ids), key=lambda t: (seen[t], -len(names[t]), names[t])))
                     for k, ids in enumerate(ids_of) if ids]


class PositionalIndex:
    """Posting lists over the words of some documents; positions run on through all of them."""

    def __init__(self, docs: list[list[bytes]], vocab: dict[bytes, int]):
        self.lengths = np.array([len(d) for d in docs], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.lengths)])
        get = vocab.get
        ids = np.array([get(w, -1) for d in docs for w in d], dtype=np.int32)
        at = np.flatnonzero(ids >= 0)
        terms = ids[at]
        order = np.argsort(terms, kind="stable")
        self.positions = at[order]
        self.count = np.bincount(terms, minlength=len(vocab))
        self.offset = np.concatenate([[0], np.cumsum(self.count)])

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.offset[term]:self.offset[term + 1]]

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, positions, side="right") - 1

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Starts of the exact phrase, rarest list first, within one document."""
        order = sorted(range(len(terms)), key=lambda j: self.count[terms[j]])
        left = self.postings(terms[order[0]]) - order[0]
        for j in order[1:]:
            if not len(left):
                return left
            shifted = self.postings(terms[j]) - j
            k = np.minimum(np.searchsorted(shifted, left), len(shifted) - 1)
            left = left[shifted[k] == left]
        left = left[left >= 0]
        return left[self.doc_of(left) == self.doc_of(left + len(terms) - 1)]

    def near(self, terms: list[int], reach: int) -> np.ndarray:
        """Positions of the first term that have every other term within ``reach`` words in the document."""
        left = self.postings(terms[0])
        for t in terms[1:]:
            if not len(left):
                return left
            doc = self.doc_of(left)
            low = np.maximum(left - reach, self.first[doc])
            high = np.minimum(left + reach, self.first[doc + 1] - 1)
            other = self.postings(t)
            k = np.searchsorted(other, low)
            left = left[(k < len(other)) & (other[np.minimum(k, len(other) - 1)] <= high)]
        return left


def _find(index: PositionalIndex, block: QueryBlock, reach: int) -> list[tuple[int, int, int, int, str]]:
    """(document, start, length, item, kind) of every match in the indexed documents."""
    found = []
    for n, terms, owners in block.windows:
        for w in np.flatnonzero(index.count[terms].min(axis=1) > 0):
            starts = index.phrase(terms[w])
            for d, s in zip(index.doc_of(starts).tolist(), starts.tolist()):
                found += [(d, s - int(index.first[d]), n, k, "phrase") for k in owners[w]]
    if reach:
        for k, n, bag in block.bags:
            if index.count[bag].min() > 0:
                at = index.near(bag, reach * n)
                for d, s in zip(index.doc_of(at).tolist(), at.tolist()):
                    found.append((d, s - int(index.first[d]), 1, k, "near"))
    return found


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[QueryBlock]:
    """The benchmark as query blocks; only one block of text is held at a time."""
    items, size = [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                            F.coalesce(F.col("text"), F.lit("")).alias("text"))
    for row in rows.toLocalIterator():
        raw = row.text.encode()
        if items and size + len(raw) > block_bytes:
            yield QueryBlock(items, window)
            items, size = [], 0
        items.append((row.item, raw))
        size += len(raw)
    yield QueryBlock(items, window)


def _searcher(block, reach: int, last: bool):
    """mapInArrow function: add the matches of one block; the last block drops the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .common import text_slices
        queries = block.value
        for batch, raws in text_slices(batches):
            docs = [words_of(raw) for raw in raws]
            index = PositionalIndex(docs, queries.vocab)
            before = batch.column(batch.schema.get_field_index("matches")).to_pylist()
            for d, s, n, k, kind in _find(index, queries, reach):
                before[d].append({"start": s, "length": n, "item": queries.items[k], "kind": kind})
            columns = {"doc_id": batch.column(0), "text": batch.column(1),
                       "n_words": pa.array(index.lengths, pa.int64()), "matches": pa.array(before, _MATCH_TYPE)}
            if last:
                del columns["text"]
            yield pa.RecordBatch.from_pydict(columns)
    return run


def find_matches(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, near: int = 0,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, matches): all benchmark matches of every document, one row per document row.

    A match is (start, length, item, kind): kind ``phrase`` is an exact window of ``window`` words (a
    shorter item is one window), word ``start`` counted from 0. With ``near`` > 0, kind ``near`` marks
    each occurrence of an item's leading term (the one in the fewest items) that has all the item's
    other terms within ``near`` item lengths on either side.

    Words are runs of ASCII letters and digits and all non-ASCII characters after lower-casing A-Z.
    Null or empty texts have no words and no matches; a null ``item_id`` is named "null"; items that
    share an id count as one; an empty benchmark matches nothing; repeated documents are judged
    each for itself; other columns of the inputs are ignored.
    """
    spark = documents.sparkSession
    df = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                          F.lit(0).cast("long").alias("n_words"), F.expr(f"cast(array() as {_MATCHES})").alias("matches"))
    blocks = [spark.sparkContext.broadcast(b) for b in _blocks(benchmark, window, block_bytes)]
    for i, block in enumerate(blocks):
        last = i == len(blocks) - 1
        schema = f"doc_id long, {'' if last else 'text string, '}n_words long, matches {_MATCHES}"
        df = df.mapInArrow(_searcher(block, near, last), schema)
    return df


def _verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {k: [] for k in ("n_hit", "n_items", "items_sha256", "contaminated", "n_near")}
        for n_words, matches in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            phrases = [m for m in matches if m["kind"] == "phrase"]
            hit, end = 0, 0
            for s, e in sorted((m["start"], m["start"] + m["length"]) for m in phrases):
                hit += max(0, e - max(s, end))
                end = max(end, e)
            items = sorted({m["item"] for m in phrases})
            out["n_hit"].append(hit)
            out["n_items"].append(len(items))
            out["items_sha256"].append(hashlib.sha256(",".join(items).encode()).hexdigest())
            out["contaminated"].append(hit > 0 and 20 * hit >= n_words)
            out["n_near"].append(len({m["item"] for m in matches if m["kind"] == "near"}))
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "n_words": batch.column(1),
            "n_hit": pa.array(out["n_hit"], pa.int64()), "n_items": pa.array(out["n_items"], pa.int64()),
            "items_sha256": pa.array(out["items_sha256"], pa.string()),
            "contaminated": pa.array(out["contaminated"], pa.bool_()), "n_near": pa.array(out["n_near"], pa.int64())})


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, near: int = 0,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: words, words hit by benchmark windows, items matched, and whether it is contaminated.

    A word inside any occurrence of a window is hit; a document is contaminated when at least a
    twentieth of its words are hit. ``n_near`` counts items with proximity matches (``near`` > 0).
    Edge cases as in ``find_matches``.
    """
    return find_matches(documents, benchmark, window, near, block_bytes).mapInArrow(
        _verdicts, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
                   "contaminated boolean, n_near long")


def _clean(block, last: bool, names: list[str], hits_name: str):
    """mapInArrow function of ``drop_contaminated``: whole rows in, rows of clean documents out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .common import text_slices
        queries = block.value
        for batch, raws in text_slices(batches):
            index = PositionalIndex([words_of(raw) for raw in raws], queries.vocab)
            ranges = batch.column(batch.schema.get_field_index(hits_name)).to_pylist()
            for d, s, n, _, _ in _find(index, queries, 0):
                ranges[d].append({"start": s, "length": n})
            if not last:
                hits = pa.array(ranges, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int32())])))
                yield batch.set_column(batch.schema.get_field_index(hits_name), hits_name, hits)
                continue
            keep = []
            for n_words, spans in zip(index.lengths.tolist(), ranges):
                hit, end = 0, 0
                for s, e in sorted((m["start"], m["start"] + m["length"]) for m in spans):
                    hit += max(0, e - max(s, end))
                    end = max(end, e)
                keep.append(not (hit > 0 and 20 * hit >= n_words))
            yield batch.select(names).filter(pa.array(keep, pa.bool_()))
    return run


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``documents`` that are not contaminated, all columns unchanged, without a shuffle."""
    spark, names = documents.sparkSession, documents.columns
    hits = unused(names, "_hits")
    df = documents.withColumn(hits, F.expr("cast(array() as array<struct<start:long,length:int>>)"))
    blocks = [spark.sparkContext.broadcast(b) for b in _blocks(benchmark, window, block_bytes)]
    for i, block in enumerate(blocks):
        last = i == len(blocks) - 1
        df = df.mapInArrow(_clean(block, last, names, hits), documents.schema if last else df.schema)
    return df
