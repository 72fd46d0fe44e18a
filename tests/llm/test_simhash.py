import re

import pytest
from pyspark.sql import functions as F
import xxhash

from tidewatch.llm import simhash
from tidewatch.llm.components import connected_components

from .helpers import ODD, documents, lower, table


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_against_brute_force(spark):
    rows = table(spark, "documents").select("doc_id", "text").collect()
    prints = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    ids = sorted(prints)
    near = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (prints[a] ^ prints[b]).bit_count() <= 4]
    expected = groups(near, ids)
    found = simhash.near_duplicates(table(spark, "documents")).collect()
    assert {r.doc_id: r.fp % (1 << 64) for r in found} == prints
    assert {r.doc_id: r.component_id for r in found} == expected


@pytest.mark.parametrize("segments", [2, 3, 4, 5])
def test_links_find_every_pair_in_every_segment(spark, segments):
    base = 0x0123456789ABCDEF
    near = [base]
    for spread in (0, 15, 16, 21, 31, 32, 42, 47, 60):
        value = base
        for k in range(4):
            value ^= 1 << (spread + 13 * k) % 64
            near.append(value)
    signed = sorted({v - (1 << 64) if v >> 63 else v for v in near})
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {(r.a, r.b) for r in simhash.links(fps, 4, segments).collect()}
    expected = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 4}
    assert found == expected


def test_odd_rows(spark):
    found = simhash.near_duplicates(documents(spark, ODD, extra=True)).collect()
    assert len(found) == len(ODD)
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append((r.fp, r.component_id))
    # null, empty and blank texts are fingerprint 0 and one group; copies are one group
    assert by_id[1] == by_id[2] == by_id[3] == [(0, 1)]
    assert [c for _, c in by_id[4] + by_id[5]] == [4, 4, 4]
    assert by_id[None][0][1] is None
    kept = simhash.drop_near_duplicates(documents(spark, ODD)).select("doc_id").collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 4, 6, 7, 8, 9, 10]


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == groups(edges, {n for e in edges for n in e})


def test_rows_are_told_apart_by_id_and_text(spark):
    rows = [(1, "a b c d e f"), (5, "a b c d e f"), (5, "quite another text of its own"), (7, "twice the same row"), (7, "twice the same row"),
            (None, "no id, and alone"), (None, "a b c d e f"), (None, "no ids here"), (None, "no ids here")]
    docs = documents(spark, rows, extra=True).withColumns({c: F.lit(1) for c in ("row", "n", "doc", "root", "first", "_row")})
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([
        (1, "a b c d e f"), (5, "quite another text of its own"), (7, "twice the same row"), (0, "no id, and alone"), (0, "no ids here")])
