"""Phrase collocations: exact counts of word pairs and triples by direct-address tiles.

Words get ids by falling frequency, so that frequent pairs lie close together at the low ids. Pairs of
two frequent words fall into square tiles that are counted with a dense ``bincount``; all other pairs
are sparse and are counted as sorted coordinate lists (COO). The pairs that are frequent enough
get ids by falling frequency themselves, and triples are counted as pairs of (pair, word) in the same
way. Texts are read once, in chunks; per chunk every distinct word or pair goes to the shuffle once with
its count, however often it occurs, so a very frequent one makes one row a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordinal import with_ordinal
from ..session import cut_lineage

#: bytes of text of a chunk
CHUNK_BYTES = 32 << 20
#: ids below HEAD on both sides are counted in dense tiles of TILE x TILE
HEAD, TILE = 2048, 256
SIDE = HEAD // TILE
#: entries that one list of coordinates should hold
LIST_ENTRIES = 4 << 20
#: chunks whose counts of one group are added up in one task
FAN = 256
#: end of a piece
END = -1

_TABLE = bytes(10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _pack(values: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes, dtype: str) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), dtype)


def _add_up(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and the sums of their counts."""
    if not len(codes):
        return codes, counts
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(counts, first)


# ---------------------------------------------------------------------------
# chunks of text -> distinct words and numbers of words
# ---------------------------------------------------------------------------

def _read_chunks(max_bytes: int):
    """Rows (text, lang) -> one row per language and chunk: its words, their counts, the words' numbers in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from .common import text_slices
        chunk = TaskContext.get().partitionId() << 33
        for batch, texts in text_slices(batches, "text", max_bytes):
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            by_lang: dict[str, list[bytes]] = {}
            for lang, raw in zip(langs, texts):
                by_lang.setdefault(lang, []).append(raw)
            for lang, own in by_lang.items():
                number: dict[bytes, int] = {}
                tokens: list[int] = []
                for raw in own:
                    for piece in raw.translate(_TABLE).split(b"\n"):
                        words = piece.split()  # by U+0020: nothing else that bytes.split() takes is left
                        if words:
                            tokens += [number.setdefault(w, len(number)) for w in words]
                            tokens.append(END)
                flat = np.array(tokens, np.int32)
                counts = np.bincount(flat[flat >= 0], minlength=len(number)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang], pa.string()), pa.array([chunk], pa.int64()),
                    pa.array([[w.decode() for w in number]], pa.list_(pa.string())),
                    pa.array([counts], pa.list_(pa.int64())), pa.array([_pack(flat)], pa.binary())],
                    ["lang", "chunk", "words", "counts", "tokens"])
                chunk += 1
    return run


def _renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks' word numbers -> ids; words without an id are replaced by the end of a piece."""
    for batch in batches:
        for chunk, tokens, map_ in zip(batch["chunk"].to_pylist(), batch["tokens"], batch["ids"]):
            flat = _unpack(tokens.as_py(), "<i4")
            ids = np.full(int(flat.max(initial=END)) + 2, END, np.int64)  # the last place answers for END
            if map_.is_valid:
                at = map_.values.field("pos").to_numpy(zero_copy_only=False)
                ids[at] = map_.values.field("id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([_pack(ids[flat])], pa.binary())], ["chunk", "ids"])


# ---------------------------------------------------------------------------
# counting pairs of a left and a right id
# ---------------------------------------------------------------------------

def _groups(left: np.ndarray, right: np.ndarray, codes: np.ndarray, lists: int) -> np.ndarray:
    """Group of each pair: a dense tile (its number), or a list of coordinates (after the tiles, by a hash of the code)."""
    dense = (left < HEAD) & (right < HEAD)
    mixed = (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    sparse = SIDE * SIDE + (mixed % np.uint64(lists)).astype(np.int64)
    return np.where(dense, (left // TILE) * SIDE + right // TILE, sparse)


def _pairs_of(chunk: int, left: np.ndarray, right: np.ndarray, width: int, lists: int) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of a chunk with their counts, one row a group."""
    valid = (left >= 0) & (right >= 0)
    codes, counts = np.unique(left[valid] * np.int64(width) + right[valid], return_counts=True)
    groups = _groups(codes // width, codes % width, codes, lists)
    order = np.argsort(groups, kind="stable")
    groups, codes, counts = groups[order], codes[order], counts[order].astype(np.int64)
    cut = np.flatnonzero(np.diff(groups)) + 1
    if len(codes):
        parts = list(zip(np.split(groups, cut), np.split(codes, cut), np.split(counts, cut)))
        yield pa.RecordBatch.from_arrays([
            pa.array([int(g[0]) for g, _, _ in parts], pa.int64()), pa.array([chunk] * len(parts), pa.int64()),
            pa.array([_pack(c) for _, c, _ in parts], pa.binary()), pa.array([_pack(n) for _, _, n in parts], pa.binary())],
            ["grp", "chunk", "codes", "counts"])


def _word_pairs(width: int, lists: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data in zip(batch["chunk"].to_pylist(), batch["ids"]):
                ids = _unpack(data.as_py(), "<i8")
                yield from _pairs_of(chunk, ids[:-1], ids[1:], width, lists)
    return run


def _sum_group(grp: int, width: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of a group: a dense tile by bincount, a list by sorting."""
    if grp >= SIDE * SIDE:
        return _add_up(np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts]))
    row, column = grp // SIDE * TILE, grp % SIDE * TILE
    total = np.zeros(TILE * TILE, np.int64)
    for codes, counts in parts:
        # floats of bincount are exact for the counts of a chunk
        total += np.bincount((codes // width - row) * TILE + codes % width - column, counts, TILE * TILE).astype(np.int64)
    cells = np.flatnonzero(total)
    return (row + cells // TILE) * np.int64(width) + column + cells % TILE, total[cells]


def _sum_groups(width: int, min_count: int | None):
    """Rows sorted by (grp, salt) -> sums: (code, a) of at least ``min_count``, or without it partial rows."""
    def emit(key: tuple[int, int], parts: list) -> pa.RecordBatch:
        codes, counts = _sum_group(key[0], width, parts)
        if min_count is None:
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()),
                                               pa.array([_pack(codes)], pa.binary()), pa.array([_pack(counts)], pa.binary())],
                                              ["grp", "chunk", "codes", "counts"])
        kept = counts >= min_count
        return pa.RecordBatch.from_arrays([pa.array(np.full(kept.sum(), key[0])), pa.array(codes[kept]), pa.array(counts[kept])], ["grp", "code", "a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, held = None, [], 0
        for batch in batches:
            for grp, salt, codes, counts in zip(batch["grp"].to_pylist(), batch["salt"].to_pylist(), batch["codes"], batch["counts"]):
                if key != (grp, salt):
                    if key is not None:
                        yield emit(key, parts)
                    key, parts, held = (grp, salt), [], 0
                parts.append((_unpack(codes.as_py(), "<i8"), _unpack(counts.as_py(), "<i8")))
                held += len(parts[-1][0])
                if held > LIST_ENTRIES:
                    parts = [_sum_group(grp, width, parts)]
                    held = len(parts[0][0]) // 2  # what can't be added up further isn't tried again at once
        if key is not None:
            yield emit(key, parts)
    return run


def _sorted_by(df: DataFrame, *keys: str, then: tuple[str, ...] = ()) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys, *then)


def _frequent(rows: DataFrame, width: int, min_count: int, chunks: int) -> DataFrame:
    """(grp, code, a) of all pairs that occur ``min_count`` times. Groups of many chunks are added up in several rounds."""
    partial = "grp long, chunk long, codes binary, counts binary"
    while chunks > FAN:
        chunks = -(-chunks // FAN)
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(chunks)))
        rows = cut_lineage(_sorted_by(salted, "grp", "salt").mapInArrow(_sum_groups(width, None), partial))
    return cut_lineage(_sorted_by(rows.withColumn("salt", F.lit(0).cast("long")), "grp", "salt").mapInArrow(
        _sum_groups(width, min_count), "grp long, code long, a long"))


# ---------------------------------------------------------------------------
# ids of frequent pairs back to the chunks, and triples
# ---------------------------------------------------------------------------

def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (grp, salt, chunk): the frequent pairs first, then each chunk's list; a chunk gets its frequent pairs."""
    key, codes, ids, table = None, [], [], None
    for batch in batches:
        groups = np.stack([batch["grp"].to_numpy(), batch["salt"].to_numpy()], 1)
        chunk = batch["chunk"].to_numpy()
        cut = np.flatnonzero((np.diff(groups, axis=0) != 0).any(1) | ((chunk[1:] >= 0) | (chunk[:-1] >= 0))) + 1
        for first, last in zip([0, *cut], [*cut, len(chunk)]):
            if first == last:
                continue
            if key != tuple(groups[first]):
                key, codes, ids, table = tuple(groups[first]), [], [], None
            if chunk[first] < 0:  # a run of frequent pairs
                codes.append(batch["code"].slice(first, last - first).to_numpy(zero_copy_only=False))
                ids.append(batch["id"].slice(first, last - first).to_numpy(zero_copy_only=False))
                continue
            if table is None:
                known = np.concatenate(codes) if codes else np.zeros(0, np.int64)
                order = np.argsort(known)
                table = known[order], (np.concatenate(ids) if ids else known)[order]
            own = _unpack(batch["codes"][first].as_py(), "<i8")
            at = np.searchsorted(table[0], own)
            hit = at < len(table[0])
            hit[hit] = table[0][at[hit]] == own[hit]
            if hit.any():
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(chunk[first])], pa.int64()), pa.array([_pack(own[hit])], pa.binary()),
                    pa.array([_pack(table[1][at[hit]])], pa.binary())], ["chunk", "codes", "found"])


def _triples(width: int, lists: int):
    """Rows sorted by chunk: its word ids and its frequent pairs -> distinct (pair, word) with counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, words, known = None, None, []

        def done() -> Iterator[pa.RecordBatch]:
            if words is None or not known or len(words) < 3:
                return
            codes, ids = np.concatenate([c for c, _ in known]), np.concatenate([i for _, i in known])
            order = np.argsort(codes)
            codes, ids = codes[order], ids[order]
            pairs = np.where((words[:-1] >= 0) & (words[1:] >= 0), words[:-1] * np.int64(width) + words[1:], -1)
            at = np.minimum(np.searchsorted(codes, pairs), len(codes) - 1)
            left = np.where(codes[at] == pairs, ids[at], END)
            # both pairs of a frequent triple are frequent
            yield from _pairs_of(key, left[:-1], np.where(left[1:] >= 0, words[2:], END), width, lists)

        for batch in batches:
            for chunk, ids, codes, found in zip(batch["chunk"].to_pylist(), batch["ids"], batch["codes"], batch["found"]):
                if chunk != key:
                    yield from done()
                    key, words, known = chunk, None, []
                if ids.is_valid:
                    words = _unpack(ids.as_py(), "<i8")
                else:
                    known.append((_unpack(codes.as_py(), "<i8"), _unpack(found.as_py(), "<i8")))
        yield from done()
    return run


def _lists(spark, entries: int) -> int:
    """Number of lists of coordinates: it grows with what is to be counted."""
    return max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries // LIST_ENTRIES), 1)


def counts(documents: DataFrame, min_count: int, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Totals per language (lang, n), and the frequent words (id, lang, word, a), pairs (id, first, second, a)
    and triples (pair, third, a); first, second and third are words' ids, pair is a pair's id."""
    spark = documents.sparkSession
    rows = documents.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    chunks = cut_lineage(rows.mapInArrow(_read_chunks(chunk_bytes), "lang string, chunk long, words array<string>, counts array<long>, tokens binary"))
    own = chunks.select("lang", "chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "w")).select(
        "lang", "chunk", "pos", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    totals = chunks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = own.groupBy("lang", "word").agg(F.sum("n").alias("a")).where(F.col("a") >= min_count)
    words = cut_lineage(with_ordinal(frequent.withColumn("_order", -F.col("a")), ["_order", "lang", "word"], "id").drop("_order"))

    found = own.join(words.select("lang", "word", "id"), ["lang", "word"]).groupBy("chunk").agg(
        F.collect_list(F.struct("pos", "id")).alias("ids"))
    texts = cut_lineage(chunks.select("chunk", "tokens").join(found, "chunk", "left").mapInArrow(_renumber, "chunk long, ids binary"))
    n_chunks, n_words = chunks.count(), words.count()
    n_tokens = totals.agg(F.sum("n")).first()[0] or 0
    width, lists = max(n_words, 1), _lists(spark, n_tokens)
    tiles = "grp long, chunk long, codes binary, counts binary"
    pair_rows = cut_lineage(texts.mapInArrow(_word_pairs(width, lists), tiles))
    pairs = cut_lineage(with_ordinal(_frequent(pair_rows, width, min_count, n_chunks).withColumn("_order", -F.col("a")), ["_order", "code"], "id").drop("_order"))

    # each group's frequent pairs meet the chunks' lists of the group; groups of many chunks in several tasks
    salts = -(-n_chunks // FAN) or 1
    asked = pair_rows.select("grp", F.pmod(F.xxhash64("chunk"), F.lit(salts)).alias("salt"), "chunk", F.lit(None).cast("long").alias("code"),
                             F.lit(None).cast("long").alias("id"), "codes")
    known = pairs.select("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"),
                         F.lit(-1).cast("long").alias("chunk"), "code", "id", F.lit(None).cast("binary").alias("codes"))
    answers = _sorted_by(known.unionByName(asked), "grp", "salt", then=("chunk",)).mapInArrow(_answer, "chunk long, codes binary, found binary")
    none = F.lit(None).cast("binary")
    both = texts.select("chunk", "ids", none.alias("codes"), none.alias("found")).unionByName(
        answers.select("chunk", none.alias("ids"), "codes", "found"))
    triple_rows = cut_lineage(_sorted_by(both, "chunk").mapInArrow(_triples(width, lists), tiles))
    triples = _frequent(triple_rows, width, min_count, n_chunks)
    pair = F.expr(f"code div {width}")
    second = F.expr(f"code % {width}")
    return (totals, words, pairs.select("id", pair.alias("first"), second.alias("second"), "a"),
            triples.select(pair.alias("pair"), second.alias("third"), "a"))


def score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 a a / (l r)), exact for counts of up to 14 digits."""
    big = [c.cast("decimal(14,0)") for c in (a, l, r)]
    top = F.lit(1000000).cast("decimal(7,0)") * big[0] * big[0]
    return F.call_function("div", top, big[1] * big[2])


def collocations(documents: DataFrame, min_count: int = 10, top: int = 2000, shadow: int = 50,
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The ``top`` phrases of two or three words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends (U+000A to U+000D) and these into
    words at blanks and tabs. Candidates occur at least ``min_count`` times (a); l and r are the counts of
    the parts of the cut with the lowest score, after the first word if scores are equal; n is the number of words of the
    language. A pair inside a triple that has ``shadow`` percent of its count or more is dropped. Equal
    scores are ordered by a, then by the phrase's bytes. A null text has no words, a null language is ``und``.
    Repeated rows all count, ids are not used, other columns are ignored; a language without candidates has
    no rows, nor has an empty table. Memory follows a chunk, the longest text or a list of coordinates.
    """
    totals, words, pairs, triples = counts(documents, min_count, chunk_bytes)
    word = lambda k: words.select(F.col("id").alias(k), F.col("word").alias(f"{k}_word"), F.col("a").alias(f"{k}_a"))
    two = cut_lineage(pairs.join(words.select(F.col("id").alias("first"), "lang", F.col("word").alias("first_word"), F.col("a").alias("first_a")), "first")
                      .join(word("second"), "second"))
    ends = two.select(F.col("first").alias("second"), F.col("second").alias("third"), F.col("a").alias("end_a"), F.col("id").alias("end"),
                      F.col("second_word").alias("third_word"), F.col("second_a").alias("third_a"))
    three = cut_lineage(triples.withColumnRenamed("a", "triple_a").join(two.withColumnRenamed("id", "pair"), "pair").join(ends, ["second", "third"]))
    longer = three.select(F.col("pair").alias("id"), "triple_a").union(three.select("end", "triple_a")).groupBy("id").agg(F.max("triple_a").alias("longer_a"))
    kept = two.join(longer, "id", "left").where(~F.coalesce(100 * F.col("longer_a") >= shadow * F.col("a"), F.lit(False)))
    phrases = kept.select("lang", F.concat_ws(" ", "first_word", "second_word").alias("phrase"), "a", F.col("first_a").alias("l"),
                          F.col("second_a").alias("r"), score(F.col("a"), F.col("first_a"), F.col("second_a")).alias("score"))
    one, other = score(F.col("triple_a"), F.col("first_a"), F.col("end_a")), score(F.col("triple_a"), F.col("a"), F.col("third_a"))
    after_first = one <= other
    phrases = phrases.unionByName(three.select(
        "lang", F.concat_ws(" ", "first_word", "second_word", "third_word").alias("phrase"), F.col("triple_a").alias("a"),
        F.when(after_first, F.col("first_a")).otherwise(F.col("a")).alias("l"),
        F.when(after_first, F.col("end_a")).otherwise(F.col("third_a")).alias("r"), F.least(one, other).alias("score")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = phrases.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
