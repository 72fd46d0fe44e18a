import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import merkle, queries

from .helpers import DOCUMENTS, ODD, SF, documents, table


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)])


def steps_of(leaves):
    """Root, and per leaf its (left, right) siblings level by level, by plain recursion over whole levels."""
    out, where, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for k, i in enumerate(where):
            run = i // 3 * 3
            out[k].append((level[run:i], level[i + 1:run + 3]))
        level = [H(*level[i:i + 3]) for i in range(0, len(level), 3)]
        where = [i // 3 for i in where]
    return level[0], out


def brute(rows, claim):
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id, leaf_of(r, r.text), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted(by_source[s], key=lambda x: x[:3] if x[0] else (x[0], 0, x[2])) for s in order}
    trees = {s: steps_of([x[2] for x in own[s]]) for s in order}
    root, above = steps_of([trees[s][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for (_, doc_id, leaf, r), own_steps in zip(own[s], trees[s][1]):
            node = leaf_of(r, claim(r))
            for left, right in own_steps + above[k]:
                node = H(*left, node, *right)
            out.append((doc_id, leaf, trees[s][0], root, H(*[x for a, b in own_steps + above[k] for x in a + b]), node, node == root))
    return out


def key(row):
    return tuple("" if v is None else str(v) for v in row)


def without_lines(r):
    tampered = zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 2 == 0
    return r.text.replace("\n", "") if tampered and r.text is not None else r.text


def postorder(level, index, sizes):
    below = [] if not level else [x for c in range(3 * index, min(3 * index + 3, sizes[level - 1])) for x in postorder(level - 1, c, sizes)]
    return [*below, (level, index)]


@pytest.mark.parametrize("height", [None, 5])
def test_closed_form_positions_are_the_postorder(height):
    for n in range(1, 90):
        sizes = merkle.level_sizes(n, height)
        places = {(lv, i): int(p) for lv in range(len(sizes)) for i, p in enumerate(merkle.position(lv, np.arange(sizes[lv]), sizes))}
        assert [places[x] for x in postorder(len(sizes) - 1, 0, sizes)] == list(range(sum(sizes)))


def test_query_equals_brute_force(spark):
    got = queries.REGISTRY["op11_merkle"](spark, SF).collect()
    assert sorted(map(key, got)) == sorted(map(key, brute(table(spark, "documents").collect(), without_lines)))
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize("levels", [1, 2])
def test_many_tiers_hot_source_and_null_fields(spark, levels):
    rnd = random.Random(7)
    rows = [(k if rnd.random() > 0.05 else None, f"text\n{k % 50}" if k % 7 else None, None if k % 11 == 0 else "en",
             "hot" if k % 3 else rnd.choice([None, "", "a", "ä", "z", "\U0001f600", "\uffff", *[f"s{i}" for i in range(40)]]), k) for k in range(400)]
    rows += [rows[5]] * 30 + [(5, "another text of id 5", "en", "hot", 1)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    claimed = F.when(F.col("n_chars") % 2 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    expected = brute(docs.collect(), lambda r: r.text + "!" if r.n_chars % 2 == 0 and r.text is not None else r.text)
    assert sorted(map(key, merkle.manifest(docs, claimed, levels).collect())) == sorted(map(key, expected))


def test_odd_rows_extra_columns_and_lone_leaf(spark):
    docs = documents(spark, ODD, extra=True).withColumns({c: F.lit(1) for c in ("tree", "idx", "n", "digest", "block", "left", "_tie", "root")})
    assert sorted(map(key, merkle.manifest(docs).collect())) == sorted(map(key, brute(docs.collect(), lambda r: r.text)))
    one = merkle.manifest(documents(spark, [(3, "a")])).collect()[0]
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == H() and one.verified


def test_empty_table(spark):
    assert merkle.manifest(documents(spark, [])).collect() == []
