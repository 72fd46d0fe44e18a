"""SimHash near-duplicates with multi-index hashing.

Fingerprints: bit b is set when it is set in more than half of the XXH64 hashes of the document's
word shingles. Linking works on distinct fingerprints only, so copies are never paired. The 64 bits
are cut into ``segments`` parts; by the pigeonhole rule two fingerprints within ``max_distance``
bits agree, in one of the parts, up to a small radius. Each fingerprint is stored once per part
under the part's value and looked up under all values of that part within the radius; matches are
verified on all 64 bits. Links are turned into components by rounds of label exchange that keep
everything distributed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import LOWER
from .components import connected_components

SHINGLE = 4
MAX_DISTANCE = 4
SEGMENTS = 3
SEED = 42

#: shingle hashes that are counted at a time
_CHUNK = 1 << 16


def shingle_hashes(raw: bytes, size: int = SHINGLE, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, in chunks; none for a text without words."""
    words = raw.translate(LOWER).split()
    if not words:
        return
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = end - length
    n = max(1, len(words) - size + 1)
    start, end = start[:n], end[len(words) - n:] if len(words) >= size else end[-1:]
    for i in range(0, n, _CHUNK):
        pieces = [joined[s:e] for s, e in zip(start[i:i + _CHUNK].tolist(), end[i:i + _CHUNK].tolist())]
        yield np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(seed)), np.uint64, len(pieces))


def fingerprint(raw: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash as a signed integer; 0 for a text without words."""
    total, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(raw, size, seed):
        total += len(hashes)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view(np.int64)[0])


def _fingerprints(size: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .common import text_slices
        for batch, raws in text_slices(batches):
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "row": batch.column(2),
                "fp": pa.array([fingerprint(raw, size, seed) for raw in raws], pa.int64())})
    return run


def fingerprints(documents: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, row, fp): fingerprint of every whole text; null or wordless texts have fingerprint 0. row is the text's hash."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _row().alias("row"))
    return rows.mapInArrow(_fingerprints(size, seed), "doc_id long, row long, fp long")


def _row() -> Column:
    """With the doc_id, what tells rows of documents apart."""
    return F.xxhash64(F.col("text").cast("string"))


def _parts(segments: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    cut = [round(64 * i / segments) for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def _ball(value: Column, width: int, radius: int) -> Column:
    """All values at up to ``radius`` raised bits (0 turned to 1) from ``value``.

    Of two values that differ in r bits, the one is not always reached from the other by raising bits
    alone when r > 1; then all flips are enumerated.
    """
    out = F.array(value)
    grown = out
    for _ in range(radius):
        one_more = F.flatten(F.transform(grown, lambda v: F.transform(
            F.sequence(F.lit(0), F.lit(width - 1)),
            lambda i: v.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))))
        grown = F.array_distinct(one_more)
        out = F.array_union(out, grown)
    if radius == 1:
        return F.filter(out, lambda v: v >= value)
    return out


def _tagged(values: Column, tag: int) -> Column:
    return F.transform(values, lambda v: v + tag)


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """(a, b) with a < b: all pairs of distinct fingerprints at ``max_distance`` or fewer differing bits.

    ``fps`` has one row per distinct fingerprint ``fp``.
    """
    full, extra = divmod(max_distance, segments)
    index, probes = [], []
    for k, (low, width) in enumerate(_parts(segments)):
        # of all segments, one of the first extra + 1 is within the full radius or one of the others below it
        radius = full if k <= extra else full - 1
        if radius < 0:
            continue
        value = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        # the segment's number in the highest byte
        index.append(value + (k << 56))
        probes.append(_tagged(_ball(value, width, radius), k << 56))
    table = fps.select(F.col("fp").alias("b"), F.explode(F.array(*index)).alias("key"))
    asked = fps.select(F.col("fp").alias("a"), F.explode(F.concat(*probes)).alias("key"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    found = table.join(asked, "key").where((F.col("a") != F.col("b")) & near)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _rooted(rows: DataFrame, max_distance: int, segments: int) -> DataFrame:
    """(fp, root, first_id) of every distinct fingerprint: its group's smallest fingerprint, its own smallest doc_id."""
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    groups = connected_components(links(distinct.select("fp"), max_distance, segments))
    return distinct.join(groups, distinct.fp == groups.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("root"))


def near_duplicates(documents: DataFrame, size: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                    segments: int = SEGMENTS, seed: int = SEED) -> DataFrame:
    """(doc_id, fp, component_id) of every document row.

    ``component_id`` is the smallest doc_id reachable over links of ``max_distance`` or fewer bits. Null
    and wordless texts share fingerprint 0 and are linked like any other. Rows without a doc_id
    get the component of their text, which is null if no member has an id; repeated rows get the
    same answer; other columns are ignored; an empty table gives an empty result.
    """
    rows = cut_lineage(fingerprints(documents, size, seed))
    of_fp = _rooted(rows, max_distance, segments)
    smallest = of_fp.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = of_fp.join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(documents: DataFrame, size: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                         segments: int = SEGMENTS) -> DataFrame:
    """``documents`` with one row of each near-duplicate group: the smallest doc_id, of its rows the smallest text hash.

    A row is told apart by its doc_id and its text, so a unique text stays whatever other rows have its id. Of rows
    that share both, one stays. Rows without a doc_id come last in their group; the one row of a group without
    ids stays. Columns of any name pass through.
    """
    last = F.lit((1 << 63) - 1)
    rows = cut_lineage(fingerprints(documents, size, SEED).withColumn("doc_id", F.coalesce("doc_id", last)))
    roots = _rooted(rows, max_distance, segments).select("fp", "root")
    copies = cut_lineage(rows.groupBy("fp", "doc_id", "row").agg(F.count("*").alias("n")).join(roots, "fp"))
    first = copies.groupBy("root").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    # n is 0 for what goes, else the number of rows of which one stays; a single row needs no mark
    marked = copies.join(first, "root").select(
        "doc_id", "row", F.when(F.struct("doc_id", "row") == F.col("first"), F.col("n")).otherwise(0).alias("n")).where("n <> 1")
    marked = cut_lineage(marked.groupBy("doc_id", "row").agg(F.max("n").alias("n")))
    own = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("doc"),
                           F.coalesce(F.col("doc_id").cast("long"), last).alias("doc_id"), _row().alias("row"))
    found = own.join(marked, ["doc_id", "row"], "left")
    kept = found.where(F.col("n").isNull())
    if not marked.where("n > 1").isEmpty():
        kept = kept.unionByName(found.where("n > 1").dropDuplicates(["doc_id", "row"]))
    return kept.select("doc.*")
