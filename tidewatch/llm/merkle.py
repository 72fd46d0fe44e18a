"""Merkle manifest of a dataset: ternary hash trees per source and over the sources, as postorder append logs.

A tree's leaves are cut into aligned blocks of 3^k consecutive leaves. One builder per block writes
the block's nodes in the order in which they are completed (postorder), as one row of a log: the
32-byte digests one after the other. Roots of blocks are the leaves of the next tier, which is built
alike, so no task holds more than one block and the number of tiers is the logarithm of the largest
tree. Proofs are read from the logs: the place of any node follows in closed form from the sizes of
the subtrees before it (:func:`position`), so siblings are addressed, not searched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordinal import with_ordinal
from ..session import cut_lineage

ARITY = 3
#: levels of a block; a block has at most 3^6 = 729 leaves
LEVELS = 6
DIGEST = 32
#: leaves that take their source's size from one row
RUN = 1000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field_code(column: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value as text."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 (binary) of the fields' codes, one after the other."""
    return F.unhex(F.sha2(F.concat(*[field_code(c) for c in columns]).cast("binary"), 256))


def level_sizes(leaves: int, height: int | None = None) -> list[int]:
    """Number of nodes of every level, leaves first, up to one node or, if given, to ``height``."""
    sizes = [leaves]
    while len(sizes) <= height if height is not None else sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // ARITY))
    return sizes


def position(level: int, index: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Place in the postorder log of the nodes ``index`` of ``level``, in closed form.

    A node is complete once ``done`` leaves are; until then floor(done / 3^t) nodes of every level t are
    complete, of which those above ``level`` that end at the same leaf come after it. The nodes that hold the
    last leaf end the log, from the leaf up to the root.
    """
    leaves, top = sizes[0], len(sizes) - 1
    done = np.minimum((np.asarray(index, np.int64) + 1) * ARITY ** level, leaves)
    before = sum(done // ARITY ** t for t in range(top + 1)) - 1
    later = sum((done % ARITY ** t == 0).astype(np.int64) for t in range(level + 1, top + 1))
    return np.where(done == leaves, sum(sizes) - 1 - (top - level), before - later)


def _hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def block_nodes(leaves: list[bytes], height: int | None) -> bytes:
    """Log of a block: the digests of all its nodes in postorder."""
    sizes = level_sizes(len(leaves), height)
    log = bytearray(DIGEST * sum(sizes))
    nodes = [d.hex() for d in leaves]
    for level in range(len(sizes)):
        if level:
            nodes = [_hash(nodes[i:i + ARITY]) for i in range(0, len(nodes), ARITY)]
        for at, node in zip(position(level, np.arange(len(nodes)), sizes).tolist(), nodes):
            log[DIGEST * at:DIGEST * (at + 1)] = bytes.fromhex(node)
    return bytes(log)


def sibling_runs(log: bytes, sizes: list[int]) -> list[tuple[list[str], list[str]]]:
    """Of every level below the root, each node's siblings to the left and to the right (hex, joined)."""
    out = []
    for level, size in enumerate(sizes[:-1]):
        nodes = [log[DIGEST * p:DIGEST * (p + 1)].hex() for p in position(level, np.arange(size), sizes).tolist()]
        runs = [i - i % ARITY for i in range(size)]
        out.append((["".join(nodes[r:i]) for i, r in enumerate(runs)],
                    ["".join(nodes[i + 1:r + ARITY]) for i, r in enumerate(runs)]))
    return out


def _height(n: int, width: int, levels: int) -> int | None:
    """Blocks of a tree with several blocks have all levels, so that runs go on in the next tier."""
    return levels if n > width else None


def _build(levels: int):
    width = ARITY ** levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = []
            for n, leaves in zip(batch["n"].to_pylist(), batch["leaves"]):
                logs.append(block_nodes(leaves.values.field("digest").to_pylist(), _height(n, width, levels)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs, pa.binary())], [*batch.schema.names, "nodes"])
    return run


def build(leaves: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """Logs of the trees, one table a tier: tree, block, n, leaves, nodes.

    ``leaves`` is (tree, idx, n, digest, ...): a leaf's tree, its number in it, the tree's number of
    leaves and the digest; further columns stay in the rows of the lowest tier.
    """
    width, tiers = ARITY ** levels, []
    while True:
        inner = [c for c in leaves.columns if c not in ("tree", "n")]
        blocks = (leaves.withColumn("block", F.expr(f"idx div {width}")).groupBy("tree", "block")
                  .agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct(*inner))).alias("leaves")))
        inside = blocks.schema["leaves"].dataType.simpleString()
        tiers.append(cut_lineage(blocks.mapInArrow(
            _build(levels), f"tree string, block long, n long, leaves {inside}, nodes binary")))
        up = tiers[-1].where(F.col("n") > width)
        if up.isEmpty():
            return tiers
        leaves = up.select("tree", F.col("block").alias("idx"), F.expr(f"(n + {width - 1}) div {width}").alias("n"),
                           F.expr(f"substring(nodes, length(nodes) - {DIGEST - 1}, {DIGEST})").alias("digest"))


#: siblings above a node, level by level, and the roots of its tree and of the whole
_ABOVE = "left array<string>, right array<string>, subroot string, root string"


def _descend(levels: int):
    width = ARITY ** levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                runs = sibling_runs(row["nodes"], level_sizes(row["m"], _height(row["n"], width, levels)))
                top = row["nodes"][-DIGEST:].hex()
                out = [{"tree": row["tree"], "idx": row["block"] * width + i,
                        "left": [a[i // ARITY ** t] for t, (a, _) in enumerate(runs)] + row["left"],
                        "right": [b[i // ARITY ** t] for t, (_, b) in enumerate(runs)] + row["right"],
                        "subroot": row["subroot"] or top, "root": row["root"] or top} for i in range(row["m"])]
                yield pa.RecordBatch.from_pylist(out, pa.schema([
                    ("tree", pa.string()), ("idx", pa.int64()), ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string())),
                    ("subroot", pa.string()), ("root", pa.string())]))
    return run


def _with_above(tier: DataFrame, tops: DataFrame | None, below: DataFrame | None, width: int) -> DataFrame:
    """Blocks of a tier with what stands above them: blocks that end their tree take it from ``tops``
    (tree, left, right, root; nothing if not given), others from the tier ``below`` whose leaves they are."""
    whole = tier.where(F.col("n") <= width)
    if tops is None:
        none = F.array().cast("array<string>")
        whole = whole.select("*", none.alias("left"), none.alias("right"), F.lit(None).cast("string").alias("subroot"),
                             F.lit(None).cast("string").alias("root"))
    else:
        whole = whole.join(tops.select("tree", "left", "right", "root"), "tree").select(
            *tier.columns, "left", "right", F.lower(F.hex(F.expr(f"substring(nodes, length(nodes) - {DIGEST - 1}, {DIGEST})"))).alias("subroot"), "root")
    if below is None:
        return whole
    parts = tier.where(F.col("n") > width).join(below.withColumnRenamed("idx", "block"), ["tree", "block"])
    return whole.unionByName(parts.select(whole.columns))


def paths(tiers: list[DataFrame], tops: DataFrame | None = None, levels: int = LEVELS) -> DataFrame:
    """Blocks of the lowest tier with the siblings above them (left, right), subroot and root."""
    above = None
    for k in range(len(tiers) - 1, -1, -1):
        ready = _with_above(tiers[k], tops, above, ARITY ** levels)
        if k == 0:
            return ready
        above = ready.select("tree", "block", "n", F.size("leaves").cast("long").alias("m"), "nodes", "left", "right", "subroot", "root") \
            .mapInArrow(_descend(levels), f"tree string, idx long, {_ABOVE}")


def _prove(levels: int):
    width = ARITY ** levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                leaves = row["leaves"]
                runs = sibling_runs(row["nodes"], level_sizes(len(leaves), _height(row["n"], width, levels)))
                above = list(zip(row["left"], row["right"]))
                over = "".join(a + b for a, b in above)
                proof, folded = [], []
                for i, leaf in enumerate(leaves):
                    own = [(a[i // ARITY ** t], b[i // ARITY ** t]) for t, (a, b) in enumerate(runs)]
                    proof.append(_hash([*(a + b for a, b in own), over]))
                    folded.append(reduce(lambda node, s: _hash([s[0], node, s[1]]), own + above, leaf["claim"].hex()))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([x["doc_id"] for x in leaves], pa.int64()),
                    "leaf": pa.array([x["digest"].hex() for x in leaves], pa.string()),
                    "subroot": pa.array([row["subroot"]] * len(leaves), pa.string()), "root": pa.array([row["root"]] * len(leaves), pa.string()),
                    "proof_sha256": pa.array(proof, pa.string()), "folded_root": pa.array(folded, pa.string())})
    return run


def manifest(documents: DataFrame, claimed: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``claimed`` is the text (an expression over ``documents``) that is checked against the manifest; by
    default the text itself. Its leaf is folded with the siblings of the original leaf up to
    ``folded_root``; ``verified`` tells whether that is the root.

    Leaves of a source are in the order of doc_id (null first), rows that repeat a doc_id in that of their
    digests. A null source is a source of its own, before all others; null fields have the code ``-`` and
    differ from empty ones. Rows that are equal are leaves of their own. A lone leaf is the subroot of its
    source, a lone source's subroot the root. Other columns are ignored. An empty table has no rows and no
    root. Texts are hashed where they are read; only digests are shuffled.
    """
    # '' for the null source, '=...' for others: the order of the sources in bytes, without nulls in joins
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    columns = [F.col(c) for c in FIELDS]
    texts = [*columns[:-1], F.col("text") if claimed is None else claimed]
    leaves = cut_lineage(documents.select(
        tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest(columns).alias("digest"),
        leaf_digest(texts).alias("claim"), F.monotonically_increasing_id().alias("_tie")))
    placed = with_ordinal(leaves, ["tree", "doc_id", "digest", "_tie"], "_at")
    sizes = placed.groupBy("tree").agg(F.min("_at").alias("_first"), F.count("*").alias("n"))
    # a source's size goes to every run of numbers that the source reaches into, so a hot source is no hot key
    run = F.sequence(F.expr(f"_first div {RUN}"), F.expr(f"(_first + n - 1) div {RUN}"))
    sizes = sizes.withColumn("_run", F.explode(run))
    tiers = build(placed.withColumn("_run", F.expr(f"_at div {RUN}")).join(sizes, ["tree", "_run"]).select(
        "tree", (F.col("_at") - F.col("_first")).alias("idx"), "n", "digest", "doc_id", "claim"), levels)

    # the tree over the sources: its leaves are the subroots
    width = ARITY ** levels
    subroots = reduce(DataFrame.unionByName, [
        t.where(F.col("n") <= width).select("tree", F.expr(f"substring(nodes, length(nodes) - {DIGEST - 1}, {DIGEST})").alias("digest"))
        for t in tiers])
    ranked = cut_lineage(with_ordinal(subroots, ["tree"], "idx"))
    total = ranked.count()
    upper = build(ranked.select(F.lit("").alias("tree"), "idx", F.lit(total).cast("long").alias("n"), "digest"), levels)
    lowest = paths(upper, None, levels).select(
        "tree", "block", "n", F.size("leaves").cast("long").alias("m"), "nodes", "left", "right", "subroot", "root")
    tops = lowest.mapInArrow(_descend(levels), f"tree string, idx long, {_ABOVE}").drop("tree").join(ranked.select("idx", "tree"), "idx")

    proven = paths(tiers, cut_lineage(tops), levels).select("n", "leaves", "nodes", "left", "right", "subroot", "root").mapInArrow(
        _prove(levels), "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))
