"""Byte-level BPE: encode texts to token ids by ranked merges, and decode ids to bytes.

Texts are read in chunks of rows. The distinct words (matches of the split pattern) that a chunk brings up for the
first time in its task become one array; Spark higher-order functions fold the ranked merges over the byte arrays
of these words, with the vocabulary as a literal map from bytes to rank. The chunk's ids are then the
words' ids in the order of the text. This is one pass without a shuffle: a task holds one chunk and the
words of the last chunks, up to a bound, and a lost task is only read again.

Words that are frequent in the corpus would be folded anew in every task. Before the pass, a part of the rows is
counted to find such words; they are folded once, up to a bound, and sent to all tasks. Which words these
are changes no result: a task folds every other word of its texts by itself.

A literal map is searched from end to end at every access, so the ranks lie in an array of small maps,
addressed by the CRC-32 of the bytes. Their keys are the bytes as hexadecimal text, because only JSON makes a
literal of this size in a moment.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import json
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: bytes of text of a chunk
CHUNK_BYTES = 4 << 20
#: words that a task remembers; with more it forgets them and begins anew
TASK_WORDS = 1 << 20
#: bytes of text that are counted to find frequent words; a corpus of no more has none sent
COUNTED_BYTES = 64 << 20
#: frequent words that are sent to all tasks
COMMON_WORDS = 500_000
#: groups in which the frequent words are folded
COMMON_GROUPS = 64
#: small maps of the literal
BUCKETS = 1 << 16
#: words of more bytes are merged from a heap, which takes n log n steps; the fold takes n squared
FOLD_BYTES = 64
#: stands for "not in the vocabulary" in arrays of ranks
NO_RANK = 2 ** 31 - 1


class Common(NamedTuple):
    """Frequent words, how many ids each has, and these ids one word after the other."""

    words: list[str]
    sizes: np.ndarray
    ids: np.ndarray


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank (which is its id) a line."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path} does not have every byte")
    return ranks


def rank_literal(ranks: dict[bytes, int], buckets: int = BUCKETS) -> Column:
    """The vocabulary as an array of ``buckets`` maps from bytes (as hexadecimal text) to rank."""
    maps: list[dict[str, int]] = [{} for _ in range(buckets)]
    for token, rank in ranks.items():
        maps[zlib.crc32(token) % buckets][token.hex().upper()] = rank
    return F.from_json(F.lit(json.dumps(maps, separators=(",", ":"))), "array<map<string,int>>")


def _fold_sql(buckets: int) -> str:
    """Ids of every word as a fold over at most as many merges as the word has bytes.

    State: ``a`` marks the bytes at which a part begins (x), ``r`` has at such a byte the rank of its part and
    the next one taken together. A step merges the pair of the lowest rank, the leftmost of equals: the
    second part's mark goes, and the ranks of the merged part with its two neighbours are looked up. A word that
    is in the vocabulary is one id without any merge; an empty one (a place kept for a long word) has no ids.
    """
    def rank(part: str) -> str:
        return f"coalesce(get(t, int(crc32({part}) % {buckets}))[hex({part})], {NO_RANK})"

    def end_after(place: str) -> str:
        """First byte after the part that begins at ``place``."""
        return f"coalesce(nullif(locate('x', s.a, {place} + 1), 0), n + 1)"

    def bind(name: str, value: str, body: str) -> str:
        return f"transform(array({value}), {name} -> {body})[0]"

    first = f"transform(sequence(1, n), i -> if(i < n, {rank('substring(w, i, 2)')}, {NO_RANK}))"
    with_next = f"if(nx > n, {NO_RANK}, {rank(f'substring(w, k, {end_after("nx")} - k)')})"
    with_last = f"if(pv < 1, x, {rank('substring(w, pv, nx - pv)')})"
    merged = f"""named_struct('a', overlay(s.a, '.', mid), 'r', transform(s.r, (x, i) -> case i
        when k - 1 then {with_next} when mid - 1 then {NO_RANK} when pv - 1 then {with_last} else x end))"""
    step = bind("k", "int(array_position(s.r, lo))", bind("mid", end_after("k"), bind("nx", end_after("mid"), bind(
        "pv", "k - 1 - length(substring_index(left(s.a, k - 1), 'x', -1))", merged))))
    round_ = bind("lo", "array_min(s.r)", f"if(lo = {NO_RANK}, s, {step})")
    fold = f"""aggregate(sequence(2, n), named_struct('a', repeat('x', n), 'r', {first}), (s, j) -> {round_},
        s -> transform(filter(sequence(1, n), i -> substring(s.a, i, 1) = 'x'), i -> {rank(f"substring(w, i, {end_after('i')} - i)")}))"""
    word = bind("whole", rank("w"), f"if(whole < {NO_RANK}, array(whole), {bind('n', 'length(w)', fold)})")
    return f"transform(words, w -> if(length(w) = 0, array(), {word}))"


def encode_words(chunks: DataFrame, ranks: dict[bytes, int], buckets: int = BUCKETS) -> DataFrame:
    """Add ``ids`` (an array of ids a word) to rows with ``words`` (array of byte arrays)."""
    return chunks.withColumn("_t", F.array(rank_literal(ranks, buckets))).withColumn(
        "ids", F.expr(f"transform(_t, t -> {_fold_sql(buckets)})[0]")).drop("_t")


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges as the fold, from a heap of pairs over a linked list of parts."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[word[i:i + 2]], i, i + 2) for i in range(n - 1) if word[i:i + 2] in ranks]
    heapq.heapify(heap)
    gone = bytearray(n)

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            rank = ranks.get(word[i:end[after[i]]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[after[i]]))

    while heap:
        _, i, stop = heapq.heappop(heap)
        if gone[i] or after[i] >= n or end[after[i]] != stop:
            continue  # one of the two parts has been merged since
        j = after[i]
        gone[j], end[i], after[i] = 1, end[j], after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [ranks[word[i:end[i]]] for i in range(n) if not gone[i]]


def _count(pattern: str, chunk_bytes: int):
    """Rows -> (word, n) of every chunk, without words that are too long for the fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        from .common import text_slices
        find = regex.compile(pattern).findall
        for _, texts in text_slices(batches, "_text", chunk_bytes):
            counts = Counter(itertools.chain.from_iterable(find(raw.decode()) for raw in texts))
            found = [(w, n) for w, n in ((w.encode(), n) for w, n in counts.items()) if 0 < len(w) <= FOLD_BYTES]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int64())], ["word", "n"])
    return run


def common_words(texts: DataFrame, ranks: dict[bytes, int], pattern: str, most: int, counted_bytes: int,
                 chunk_bytes: int = CHUNK_BYTES, buckets: int = BUCKETS) -> Common:
    """At most ``most`` frequent words of ``texts`` (_text) with their ids.

    They are looked for in the texts whose hash falls into a part of about ``counted_bytes``. A corpus of no
    more than that has none. The driver receives the chosen words with their ids, and the counts of counts.
    """
    nothing = Common([], np.zeros(0, np.int32), np.zeros(0, np.int32))
    size = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    if most <= 0 or size <= counted_bytes:
        return nothing
    part = texts.where(F.pmod(F.xxhash64("_text"), F.lit(-(-size // max(1, counted_bytes)))) == 0)
    counts = cut_lineage(part.mapInArrow(_count(pattern, chunk_bytes), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    # the least count with which no more than ``most`` words are taken; a word that occurs once is not frequent
    least, taken = None, 0
    for row in sorted(counts.where("n > 1").groupBy("n").agg(F.count("*").alias("words")).collect(), reverse=True):
        if taken + row.words > most:
            break
        least, taken = row.n, taken + row.words
    if least is None:
        return nothing
    grouped = counts.where(F.col("n") >= least).groupBy(F.pmod(F.xxhash64("word"), F.lit(COMMON_GROUPS)).alias("group")).agg(
        F.collect_list("word").alias("words"))
    words, sizes, flat = [], [nothing.sizes], [nothing.ids]
    for row in encode_words(grouped.select("words"), ranks, buckets).select(
            "words", F.transform("ids", F.size).alias("sizes"), F.flatten("ids").alias("ids")).toArrow().to_batches():
        words += [w.decode() for w in row["words"].flatten().to_pylist()]
        sizes.append(row["sizes"].flatten().to_numpy(zero_copy_only=False).astype(np.int32))
        flat.append(row["ids"].flatten().to_numpy(zero_copy_only=False).astype(np.int32))
    return Common(words, np.concatenate(sizes), np.concatenate(flat))


def _split(pattern: str, chunk_bytes: int, task_words: int, columns: list[str], known: Broadcast):
    """Rows -> chunks: the rows' columns as they are, the words not seen before, and per row the numbers of its words.

    The first numbers are those of the ``known`` words. ``anew`` marks a chunk before which all others were forgotten.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        from .common import text_slices
        find = regex.compile(pattern).findall
        common = len(known.value)
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__  # a new word gets the next number
        number.update((w, k) for k, w in enumerate(known.value))
        for batch, texts in text_slices(batches, "_text", chunk_bytes):
            anew = len(number) - common >= task_words
            if anew:
                number.clear()
                number.update((w, k) for k, w in enumerate(known.value))
            seen, rows = len(number), []
            for raw in texts:
                found = find(raw.decode())
                rows.append(np.fromiter(map(number.__getitem__, found), "<u4", len(found)).tobytes())
            words = [w.encode() for w in itertools.islice(reversed(number), len(number) - seen)][::-1]
            keys = pa.StructArray.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in columns], columns)
            yield pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays([0, len(keys)], keys),
                pa.array([rows], pa.list_(pa.binary())),
                pa.array([[b"" if len(w) > FOLD_BYTES else w for w in words]], pa.list_(pa.binary())),
                pa.array([[w for w in words if len(w) > FOLD_BYTES]], pa.list_(pa.binary())),
                pa.array([anew])], ["keys", "rows", "words", "long_words", "anew"])
    return run


def _join(path: str, columns: list[str], known: Broadcast):
    """Chunks with the ids of their new words, in the order of their task -> rows with their ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path)
        size, flat = known.value
        for batch in batches:
            for c in range(batch.num_rows):
                lists = batch["ids"][c].values
                new_size = np.diff(lists.offsets.to_numpy())
                new = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                missing = np.flatnonzero(new_size == 0)
                if len(missing):  # words longer than the fold takes, in the order of the words
                    parts = np.split(new, np.cumsum(new_size)[:-1])
                    for w, word in zip(missing, batch["long_words"][c].as_py()):
                        parts[w] = np.array(merge_long(word, ranks), np.int32)
                    new_size, new = np.array([len(p) for p in parts], np.int32), np.concatenate(parts)
                if batch["anew"][c].as_py():
                    size, flat = known.value
                size, flat = np.concatenate([size, new_size]), np.concatenate([flat, new])
                start = np.cumsum(size, dtype=np.int64) - size
                keys = batch["keys"][c].values
                rows = batch["rows"][c].values
                at = 0
                while at < len(rows):  # rows of about a million ids at a time
                    ids, total, first = [], 0, at
                    while at < len(rows) and (total < 1 << 20 or at == first):
                        word = np.frombuffer(rows[at].as_buffer(), "<u4")
                        n = size[word]
                        where = np.repeat(start[word] - (np.cumsum(n, dtype=np.int64) - n), n) + np.arange(n.sum())
                        ids.append(flat[where])
                        total += len(where)
                        at += 1
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                    arrays = [keys.field(k).slice(first, at - first) for k in range(len(columns))]
                    yield pa.RecordBatch.from_arrays(
                        [*arrays, pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids))),
                         pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())], [*columns, "ids", "packed"])
    return run


def encode(documents: DataFrame, path: str, pattern: str, keep: list[str] | None = None,
           chunk_bytes: int = CHUNK_BYTES, buckets: int = BUCKETS, task_words: int = TASK_WORDS,
           most_common: int = COMMON_WORDS, counted_bytes: int = COUNTED_BYTES) -> DataFrame:
    """``documents``' columns ``keep`` (by default doc_id), ``ids``, the token ids of the whole text, and ``packed``, the
    same as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded by itself, without special tokens; a text that the pattern does not
    cover loses what is between matches, as it does in the tiktoken library. A null or empty text has no
    ids. Rows are not told apart by anything, so repeated rows and rows without an id each have theirs; an
    empty table has no rows; columns outside ``keep`` are ignored. ``path`` is read on the
    driver and on the workers. A single very long text is a chunk of its own, so memory follows the longest
    text; words of more than ``FOLD_BYTES`` bytes are merged in the task, the same way, from a heap.
    Up to ``most_common`` frequent words, see ``common_words``, are encoded beforehand.
    """
    keep = keep or ["doc_id"]
    kept = documents.select(*keep, F.col("text").cast("string").alias("_text"))
    inside = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    ranks = read_ranks(path)
    common = common_words(kept.select("_text"), ranks, pattern, most_common, counted_bytes, chunk_bytes, buckets)
    send = documents.sparkSession.sparkContext.broadcast
    chunks = kept.mapInArrow(_split(pattern, chunk_bytes, task_words, keep, send(common.words)),
                             f"keys array<struct<{inside}>>, rows array<binary>, words array<binary>, long_words array<binary>, anew boolean")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return encode_words(chunks, ranks, buckets).mapInArrow(_join(path, keep, send((common.sizes, common.ids))), f"{columns}, ids array<int>, packed binary")


def decode(ids: Column, path: str) -> Column:
    """Bytes of an array of ids: the tokens' pieces, one after the other. Null for null; an id that is not in
    the vocabulary is an error."""
    ranks = read_ranks(path)
    # a byte is a character up to U+00FF, so that pieces can be joined as text
    pieces = [""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.decode("latin-1")
    table = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    joined = F.transform(F.array(table), lambda t: F.array_join(F.transform(ids, lambda i: F.element_at(t, i + 1)), ""))
    return F.encode(F.element_at(joined, 1), "ISO-8859-1")
