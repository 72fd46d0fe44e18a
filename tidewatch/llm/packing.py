"""Sequence packing by harmonic (reciprocal-capacity) classes.

Class k holds pieces that fill 1/k of a sequence, so a bin of class k takes exactly k pieces and bins
of a class can be filled without looking at any other bin. Documents may be cut, so each is cut into
pieces of capacity / k tokens for k = 1, 2, 4, ..., capacity: whole sequences first, then the binary
digits of the rest. Bins of every class are then full to the last token. Workers fill bins
independently: pieces of a class are dealt to groups in turn, and a group numbers its own bins.
The last, incomplete bin of a group is split at powers of two, which needs no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

CAPACITY = 1024
END_ID = 0
#: pieces that one group of a class numbers
GROUP_ROWS = 20_000


@lru_cache(maxsize=2)
def _encoder(path: str):
    """Encode function of a byte-level BPE vocabulary file of the tokenizers library.

    The vocabulary and its merge order are read from the file and given to tiktoken, which returns
    the same ids several times faster; its added tokens are matched in the text, as tokenizers does.
    A text that it gives up on (a run of very many blanks) goes to the tokenizers library itself.
    """
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(letters)]
    byte_of = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(rest)}
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in added}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    encoding = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

    def encode(text: str) -> list[int]:
        try:
            return encoding.encode(text, allowed_special="all")
        except ValueError:
            return _plain_tokenizer(path).encode(text, add_special_tokens=False).ids
    return encode


@lru_cache(maxsize=2)
def _plain_tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def cuts(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences, then the binary digits of the rest."""
    full, rest = divmod(tokens, capacity)
    out = [(i * capacity, capacity) for i in range(full)]
    start, length = full * capacity, capacity // 2
    while rest:
        if rest >= length:
            out.append((start, length))
            start, rest = start + length, rest - length
        length //= 2
    return out


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .common import text_slices
        encode = _encoder(path)
        for batch, raws in text_slices(batches):
            rows, start, length, crc, total = [], [], [], [], []
            for i, raw in enumerate(raws):
                ids = np.array(encode(raw.decode()) + [end_id], dtype="<u4")
                data = memoryview(ids).cast("B")
                for s, n in cuts(len(ids), capacity):
                    rows.append(i)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(data[4 * s:4 * (s + n)]))
                    total.append(len(ids))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).take(pa.array(rows, pa.int64())), "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": pa.array(total, pa.int64())})
    return run


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``capacity`` is a power of two. A document's tokens are its ids and ``end_id``; a null or empty text
    has that one token. Every token is in exactly one piece, and every sequence is filled to a power
    of two, so none is padded. Rows that repeat a doc_id, and rows without one, are documents of their
    own; other columns are ignored; an empty table gives no pieces. The tokenizer file is read by
    its path on every worker.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = cut_lineage(rows.mapInArrow(
        _pieces(tokenizer_path, capacity, end_id),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"))
    groups = 1 + pieces.count() // group_rows
    # dealt in turn over the checkpointed rows: even groups, whatever ids repeat
    dealt = pieces.withColumn("_group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
    group = Window.partitionBy("length", "_group")
    in_order = group.orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    per_bin = (F.lit(capacity) / F.col("length")).cast("long")
    placed = (dealt.withColumn("_rank", F.row_number().over(in_order).cast("long") - 1)
              .withColumn("_size", F.count("*").over(group))
              .withColumn("_k", per_bin)
              .withColumn("_bin", F.expr("_rank div _k")).withColumn("_slot", F.expr("_rank % _k"))
              # pieces of the group's last bin, if that isn't full; 0 else
              .withColumn("_open", F.expr("case when (_bin + 1) * _k > _size then _size - _bin * _k else 0 end")))
    # An open bin of m pieces is split where the binary digits of m end: the part of a slot starts at the
    # highest bits that slot and m have in common, and is as long as the next digit of m.
    # first slot of the part: clear from m the bits at and below the highest bit in which m and slot differ
    high = F.expr("shiftleft(1L, length(bin(greatest(_open ^ _slot, 1L))) - 1)")
    part = F.when(F.col("_open") > 0, F.expr("_open - (_open % (2 * _high))")).otherwise(F.lit(0)).cast("long")
    placed = placed.withColumn("_high", high).withColumn("_part", part)
    # sequence number: group, class (log2 of the length), bin, first slot
    bits = capacity.bit_length() - 1
    sequence = F.expr(f"(((_group * {bits + 2} + length(bin(length))) * (1 + {group_rows} * 64L) + _bin) * {capacity}) + _part")
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", sequence.cast("long").alias("sequence_id"),
        ((F.col("_slot") - F.col("_part")) * F.col("length")).cast("long").alias("offset"))
