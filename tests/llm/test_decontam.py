import hashlib
import random
import re

import pytest

from tidewatch.llm import decontam

from .helpers import ODD, documents, lower, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(texts, items, window=13):
    grams = {}
    for item, text in items:
        words = WORD.findall(lower(text or ""))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            grams.setdefault(tuple(words[i:i + n]), set()).add("null" if item is None else str(item))
    out = []
    for text in texts:
        words, hit, found = WORD.findall(lower(text or "")), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(words) - n + 1):
                gram = tuple(words[i:i + n])
                if gram in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[gram]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return out


def values(rows):
    return [(r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows]


@pytest.mark.parametrize("block_bytes", [16 << 20, 2000])
def test_given_tables_against_brute_force(spark, block_bytes):
    docs, bench = table(spark, "documents"), table(spark, "benchmark")
    rows = sorted(decontam.contamination(docs, bench, block_bytes=block_bytes).collect(), key=lambda r: r.doc_id)
    plain = sorted(docs.collect(), key=lambda r: r.doc_id)
    expected = brute([r.text for r in plain], [(r.item_id, r.text) for r in bench.collect()])
    assert values(rows) == expected and any(e[4] for e in expected)
    clean = decontam.drop_contaminated(docs, bench, block_bytes=block_bytes)
    assert clean.columns == docs.columns
    assert sorted(clean.collect()) == [r for r, e in zip(plain, expected) if not e[4]]


def test_small_vocabulary_with_repeats(spark):
    rng = random.Random(1)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(k, text(rng.randint(1, 20))) for k in range(12)] + [(3, "a b"), (None, "c c c"), (30, ""), (31, None), (32, "a a a a a a a a a a a a a")]
    docs = [(k, text(rng.randint(0, 400))) for k in range(40)] + [(99, "a " * 700)]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "1 as doc_id", "2 as matches")
    rows = sorted(decontam.contamination(documents(spark, docs, extra=True), bench).collect(), key=lambda r: r.doc_id)
    assert values(rows) == brute([t for _, t in docs], items)


def test_proximity(spark):
    item = "the quick brown fox"
    docs = [(1, "a quick and brown old fox sat by the door"), (2, "quick " + "x " * 40 + "brown fox the"), (3, "nothing here")]
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: r.n_near for r in decontam.contamination(documents(spark, docs), bench, near=2).collect()}
    assert got == {1: 1, 2: 0, 3: 0}


def test_matches_carry_positions(spark):
    bench = spark.createDataFrame([(7, "one two three")], "item_id long, text string")
    row = decontam.find_matches(documents(spark, [(1, "zero One, TWO three; one two three")]), bench).collect()[0]
    assert [(m.start, m.length, m["item"], m.kind) for m in row.matches] == [(1, 3, "7", "phrase"), (4, 3, "7", "phrase")]


def test_odd_rows_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, "same words in this text here"), (2, "é")], "item_id long, text string")
    rows = decontam.contamination(documents(spark, ODD), bench).collect()
    key = lambda x: repr(x)
    assert sorted(values(rows), key=key) == sorted(brute([t for _, t in ODD], [(1, "same words in this text here"), (2, "é")]), key=key)
    assert decontam.contamination(documents(spark, []), bench).collect() == []
    assert {r.n_hit for r in decontam.contamination(documents(spark, ODD), bench.where("false")).collect()} == {0}
