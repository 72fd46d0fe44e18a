"""Line deduplication by an exact set-similarity join, in DataFrame functions only.

A line's tokens are its distinct shingles of ``shingle`` words (fewer words: the whole line). A line
is removed when an earlier line, by (doc_id, line number), has a Jaccard similarity of ``threshold``
or more; equal lines have similarity 1. Lines of fewer than ``min_words`` words stay. Rows without a
doc_id, or that share one, are told apart by the hash of their texts, which also orders them.

Equal lines are merged into one before they are paired. Tokens are ordered by rarity: how often
their hash bucket occurs in all lines, then by hash. Two lines that are similar enough share a
token among the first n - ceil(t n) + 1 of each (prefix filter), have lengths within a factor t
(length filter) and enough tokens left behind the shared one (positional filter), differ in few bits
of 64 parities of their tokens (parity filter), and what their prefixes share must be enough with all
that can follow. Only pairs of lines that pass all of these are fetched and their Jaccard similarity
verified. Before that, each line is compared with one or two leaders, which settles large groups of
near copies without their pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffles_freed, stored

SHINGLE = 5
MIN_WORDS = 5
THRESHOLD = 0.8

#: hash buckets whose token counts give the order of rarity; the counts are sent to all tasks
RARITY_BUCKETS = 1 << 16

# Generators below are outer ones: for the others Spark adds a filter on the array's size, which would
# compute the array twice. No array here is empty.

#: lines whose texts are fetched by a broadcast of their hashes (8 bytes each); beyond, by a shuffle
BROADCAST_ROWS = 200_000

#: rounding guard of t * n
_EPS = 1e-9


def row_key(doc_id: str, row: str) -> tuple[Column, Column]:
    """Columns that identify a row of documents: its id, the largest long if it has none, and its text's hash."""
    return (F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias(doc_id),
            F.xxhash64(F.col("text").cast("string")).alias(row))


def line_table(documents: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, row, line_no, line, h1, h2) of every trimmed line with enough words; h1, h2 identify the line.

    Words are what spaces separate. See ``row_key`` for (doc_id, row).
    """
    rows = documents.select(*row_key("doc_id", "row"), F.posexplode_outer(F.split(F.col("text").cast("string"), "\n", -1)).alias("line_no", "line"))
    lines = rows.withColumn("line", F.trim("line"))
    # what precedes the last of min_words - 1 spaces is the whole line if it has fewer
    enough = F.octet_length(F.substring_index("line", " ", min_words - 1)) < F.octet_length("line") if min_words > 1 else F.col("line").isNotNull()
    return lines.where(enough).select(
        "doc_id", "row", "line_no", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def _places(words: Column, size: int) -> Column:
    """Where the runs of ``size`` words begin; a line of fewer words is one run."""
    return F.sequence(F.lit(0), F.greatest(F.size(words) - size, F.lit(0)))


def _hash_at(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(size)])


def _shingles(line: Column, size: int) -> Column:
    """The distinct 64-bit hashes of the line's runs of ``size`` words; of a line of fewer words, the hash of them all.

    One expression with its words bound inside, so that no optimizer rule can copy the split into the loop.
    """
    def hashes(words: Column) -> Column:
        return F.array_distinct(F.transform(_places(words, size), lambda i: _hash_at(words, i, size)))
    return F.get(F.transform(F.array(F.split(line, " ", -1)), hashes), F.lit(0))


def rarity(lines: DataFrame, shingle: int, buckets: int) -> bytes:
    """For each hash bucket of tokens, the binary logarithm of how many tokens of all lines fall into it.

    The driver receives ``buckets`` numbers at most, whatever the size of the table.
    """
    words, at = F.col("words"), F.col("at")
    # one row a run, so that the hash is compiled with the rest of the stage; functions of arrays are interpreted
    places = lines.select(F.split("line", " ", -1).alias("words")).select("words", F.explode_outer(_places(words, shingle)).alias("at"))
    counted = places.groupBy(F.pmod(_hash_at(words, at, shingle), F.lit(buckets)).cast("int").alias("bucket")).agg(
        F.ceil(F.log2(1 + F.count("*"))).cast("int").alias("size"))
    sizes = bytearray([0]) * buckets
    for row in counted.collect():
        sizes[row.bucket] = row.size
    return bytes(sizes)


def _at_least(threshold: float, n: Column) -> Column:
    return F.ceil(F.lit(threshold) * n - _EPS)


def _prefix(threshold: float, n: Column) -> Column:
    """Number of a line's first tokens one of which a similar line has among its own first ones."""
    return (n - _at_least(threshold, n) + 1).cast("int")


def _overlap(threshold: float, an: Column, bn: Column) -> Column:
    """Number of tokens that two lines of an and bn tokens share at least if they are similar."""
    return F.ceil(F.lit(threshold / (1 + threshold)) * (an + bn) - _EPS)


def _parity(tokens: Column) -> Column:
    """64 bits of a set of tokens: a bit is set if an odd number of them falls on it, by their first 6 bits."""
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda bits, t: bits.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(t, 58).cast("int"))))


def _near(threshold: float, an: Column, aparity: Column, bn: Column, bparity: Column) -> Column:
    """Whether two lines can be similar by the parities of their tokens.

    Tokens of both lines cancel out and any other one turns one bit, so the lines have at least as many
    tokens that they do not share as bits in which they differ.
    """
    return F.bit_count(aparity.bitwiseXOR(bparity)) <= an + bn - 2 * _overlap(threshold, an, bn)


def prefixes(lines: DataFrame, sizes: bytes, shingle: int, threshold: float) -> DataFrame:
    """``lines`` with n, low, high, parity, prefix instead of line: the number of its tokens, the smallest and largest of them, the parity
    of all (``_parity``), and its rarest ones.

    ``sizes`` is the result of ``rarity``.
    """
    sets = lines.withColumn("tokens", _shingles(F.col("line"), shingle))
    table = F.from_json(F.lit(str(list(sizes))), "array<tinyint>")
    size_of = lambda t: F.coalesce(F.get(table, F.pmod(t, F.lit(len(sizes))).cast("int")), F.lit(0).cast("tinyint"))
    # 6 bits of rarity above 57 bits of the hash: one number to sort by and to compare
    ranked = F.sort_array(F.transform("tokens", lambda t: F.shiftleft(size_of(t).cast("long"), 57) + F.shiftrightunsigned(t, 7)))
    n = F.size("tokens")
    return sets.select(*[c for c in lines.columns if c != "line"], n.alias("n"), F.array_min("tokens").alias("low"),
                       F.array_max("tokens").alias("high"), _parity(F.col("tokens")).alias("parity"), F.slice(ranked, F.lit(1), _prefix(threshold, n)).alias("prefix"))


def different_lines(sets: DataFrame) -> DataFrame:
    """``prefixes`` of each different line (h1, h2) once, with its first place (doc_id, line_no, row) and the number of copies.

    Lines are merged when their texts are no longer there: prefixes are a fraction of the text to shuffle.
    """
    rest = [c for c in sets.columns if c not in ("h1", "h2", "doc_id", "line_no", "row")]
    merged = sets.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "line_no", "row", *rest)).alias("first"), F.count("*").alias("copies"))
    return merged.select("h1", "h2", "first.*", "copies")


def leader_pairs(sets: DataFrame, threshold: float) -> DataFrame:
    """(a1, b1): each line with the first line that has the same smallest, or the same largest, token, if the parity filter passes them.

    At most two pairs a line, however many lines are alike. ``sets`` is the result of ``different_lines``.
    """
    marks = sets.select("h1", "doc_id", "n", "parity", F.posexplode_outer(F.array("low", "high")).alias("end", "token"))
    # most tokens are those of a single line, which meets nobody
    shared = marks.groupBy("end", "token").agg(F.min("doc_id").alias("earliest"), F.count("*").alias("lines")).where("lines > 1").drop("lines")
    met = cut_lineage(marks.join(shared, ["end", "token"]))
    leaders = met.where("doc_id = earliest").groupBy("end", "token").agg(F.min(F.struct("h1", "n", "parity")).alias("a"))
    near = _near(threshold, F.col("a.n"), F.col("a.parity"), F.col("n"), F.col("parity"))
    return met.join(leaders, ["end", "token"]).where((F.col("a.h1") != F.col("h1")) & near).select(
        F.col("a.h1").alias("a1"), F.col("h1").alias("b1")).distinct()


def candidate_pairs(sets: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """(a1, b1): 64-bit hashes, a1 < b1, of lines that pass the prefix, length, parity and positional filters.

    ``sets`` is the result of ``different_lines``; ``known`` (h1) are lines that are known to be removed: two of
    them need not be compared, nor one of them with a line before it, as the later line of a pair is the one that goes.
    Postings are the bulk of what is shuffled, once for both sides of the join: a token, a line's hash, first
    document and parity, and its length, the token's place and whether the line is known in one number.
    The parity filter belongs to the join: pairs that only have a common phrase grow with the square of
    the lines that have it, and end there.
    """
    known = known.select("h1").distinct().withColumn("known", F.lit(1))
    few = known.count() <= BROADCAST_ROWS
    flagged = sets.select("h1", "doc_id", "n", "parity", "prefix").join(F.broadcast(known) if few else known, "h1", "left")
    postings = flagged.select("h1", "doc_id", "n", "parity", F.coalesce("known", F.lit(0)).alias("known"), F.posexplode_outer("prefix").alias("at", "token")).select(
        "token", "h1", "doc_id", "parity", (F.col("n").cast("long") * (1 << 32) + F.col("at") * 2 + F.col("known")).alias("place")).repartition("token")

    def parts(name: str) -> list[Column]:
        place = F.col(f"{name}.place")
        return [F.shiftright(place, 32).cast("int"), F.shiftright(place.bitwiseAND(F.lit((1 << 32) - 1)), 1).cast("int"), place.bitwiseAND(F.lit(1))]
    (an, aat, aknown), (bn, bat, bknown) = parts("a"), parts("b")
    undecided = (aknown + bknown == 0) | ((aknown > bknown) & (F.col("a.doc_id") <= F.col("b.doc_id"))) | (
        (aknown < bknown) & (F.col("a.doc_id") >= F.col("b.doc_id")))
    # both sides are the same shuffled rows as they are; columns computed here would be a shuffle of each side
    met = postings.alias("a").join(postings.alias("b"), F.col("a.token") == F.col("b.token")).where(
        (F.col("a.h1") < F.col("b.h1")) & undecided & (F.least(an, bn) >= _at_least(threshold, F.greatest(an, bn)))
        & _near(threshold, an, F.col("a.parity"), bn, F.col("b.parity")))
    met = met.select(F.col("a.h1").alias("a1"), F.col("b.h1").alias("b1"), an.alias("an"), bn.alias("bn"), F.least(an - aat, bn - bat).alias("left"))
    overlap = _overlap(threshold, F.col("an"), F.col("bn"))
    # Positional filter: from the first shared token on, both lines have enough left.
    left = F.max("left")
    # The prefix that ends first, in the order of tokens, has been compared in full: beyond it, that line has
    # n - prefix tokens left to share. Which one ends first is not known, so the larger rest counts.
    rest = F.greatest(F.col("an") - _prefix(threshold, F.col("an")), F.col("bn") - _prefix(threshold, F.col("bn")))
    return met.groupBy("a1", "b1", "an", "bn").agg(F.count("*").alias("shared"), left.alias("left")).where(
        (F.col("left") >= overlap) & (F.col("shared") + rest >= overlap)).select("a1", "b1")


def similar_lines(lines: DataFrame, sets: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """(h1, h2) of the lines whose first copy comes after that of a similar line; ``sets`` is the result of ``different_lines``.

    In a large group of near copies nearly every line is similar to one of the group's first ones, and is found by
    being compared with those alone. The complete join then needs no pair of lines that are both found.
    """
    found = cut_lineage(_later(leader_pairs(sets, threshold), lines, shingle, threshold))
    rest = _later(candidate_pairs(sets, found, threshold), lines, shingle, threshold)
    return found.union(rest).distinct()


def _later(pairs: DataFrame, lines: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """(h1, h2) of the later line of each pair (a1, b1) whose Jaccard similarity reaches the threshold."""
    pairs = cut_lineage(pairs)
    wanted = cut_lineage(pairs.select(F.col("a1").alias("h1")).union(pairs.select(F.col("b1").alias("h1"))).distinct())
    few = wanted.count() <= BROADCAST_ROWS
    first = cut_lineage(lines.join(F.broadcast(wanted) if few else wanted, "h1")
                        .groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "line_no", "row", "line")).alias("first")))
    left = first.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("first").alias("x"))
    right = first.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("first").alias("y"))
    sets = pairs.join(left, "a1").join(right, "b1").select(
        "a1", "a2", "b1", "b2", F.struct("x.doc_id", "x.line_no", "x.row").alias("x_at"), F.col("x.line").alias("x_line"),
        F.struct("y.doc_id", "y.line_no", "y.row").alias("y_at"), F.col("y.line").alias("y_line"))
    both = F.struct(_shingles(F.col("x_line"), shingle).alias("s"), _shingles(F.col("y_line"), shingle).alias("t"))
    counts = lambda p: F.struct(F.size(F.array_intersect(p["s"], p["t"])).alias("common"), (F.size(p["s"]) + F.size(p["t"])).alias("all"))
    enough = lambda c: c["common"] / (c["all"] - c["common"]) >= threshold - _EPS
    # bound step by step, as Spark would copy columns into the filter
    similar = F.get(F.transform(F.transform(F.array(both), counts), enough), F.lit(0))
    later = F.col("x_at") > F.col("y_at")
    return sets.where(similar).select(
        F.when(later, F.col("a1")).otherwise(F.col("b1")).alias("h1"), F.when(later, F.col("a2")).otherwise(F.col("b2")).alias("h2")).distinct()


def removed_lines(documents: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, min_words: int = MIN_WORDS,
                  buckets: int = RARITY_BUCKETS) -> DataFrame:
    """(doc_id, row, line_no) of every line that an equal or similar line precedes; line numbers from 0.

    Rows that share both a doc_id and a text count as one document; rows without a doc_id come last,
    with the largest long as their id here. Null and empty texts have no lines to remove.
    """
    lines = line_table(documents, min_words)
    with shuffles_freed(documents.sparkSession):  # only what is stored is read again
        different = stored(different_lines(prefixes(lines, rarity(lines, shingle, buckets), shingle, threshold)))
        later = similar_lines(lines, different, shingle, threshold).withColumn("later", F.lit(True))
        first = different.select("h1", "h2", F.struct("doc_id", "line_no", "row").alias("first"), "copies")
        # only lines that go or have copies can lose a place
        verdict = cut_lineage(first.join(later, ["h1", "h2"], "left").where("later or copies > 1"))
    kept = (F.struct("doc_id", "line_no", "row") == F.col("first")) & F.col("later").isNull()
    places = lines.select("doc_id", "row", "line_no", "h1", "h2")
    return places.join(verdict, ["h1", "h2"]).where(~kept).select("doc_id", "row", "line_no").distinct()


def dedup_lines(documents: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, min_words: int = MIN_WORDS,
                buckets: int = RARITY_BUCKETS, name: str = "removed") -> DataFrame:
    """``documents`` with its texts without the removed lines, and ``removed``: the numbers of these lines.

    A document keeps its row even if no line is left; null texts stay null. ``name`` is the new column's name; a
    column of ``documents`` that has it is replaced, others pass through whatever their names. See ``removed_lines``.
    """
    gone = removed_lines(documents, shingle, threshold, min_words, buckets)
    # one document's own line numbers
    gone = gone.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list("line_no")).alias("removed"))
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("doc"), *row_key("doc_id", "row"))
    out = rows.join(gone, ["doc_id", "row"], "left")
    text = F.col("doc.text")
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains("removed", i)), "\n")
    text = F.when(F.col("removed").isNull(), text).otherwise(kept).alias("text")
    return out.select(*[text if c == "text" else F.col("doc").getField(c).alias(c) for c in documents.columns if c != name],
                      F.coalesce("removed", F.expr("cast(array() as array<int>)")).alias(name))
