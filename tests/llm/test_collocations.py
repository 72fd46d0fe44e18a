import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import collocations as co
from tidewatch.llm import queries

from .helpers import DOCUMENTS, ODD, SF, documents, lower, table


def brute(rows, min_count=10, top=2000, shadow=50):
    """Counters of all words, pairs and triples; Python's integers are exact."""
    found = defaultdict(lambda: [Counter() for _ in range(4)])
    for text, lang in rows:
        own = found["und" if lang is None else lang]
        for piece in re.split("[.,;:!?\n-\r]", lower(text or "")):
            words = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                own[k].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in found.items():
        cand = {}
        for k in (2, 3):
            for phrase, a in own[k].items():
                if a >= min_count:
                    score, cut = min((10 ** 6 * a * a // (own[j][phrase[:j]] * own[k - j][phrase[j:]]), j) for j in range(1, k))
                    cand[phrase] = (a, own[cut][phrase[:cut]], own[k - cut][phrase[cut:]], score)
        gone = {part for phrase, v in cand.items() if len(phrase) == 3 for part in (phrase[:2], phrase[1:]) if 100 * v[0] >= shadow * cand[part][0]}
        best = sorted((-v[3], -v[0], " ".join(p).encode(), v) for p, v in cand.items() if p not in gone)[:top]
        out += [(lang, k + 1, p.decode(), *v[:3], sum(own[1].values()), v[3]) for k, (_, _, p, v) in enumerate(best)]
    return sorted(out)


def result(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_query_equals_brute_force(spark):
    rows = [(r.text, r.lang) for r in table(spark, "documents").collect()]
    assert result(queries.REGISTRY["op12_collocations"](spark, SF)) == brute(rows)


@pytest.mark.parametrize("small", [False, True])
def test_small_vocabulary_in_many_chunks(spark, monkeypatch, small):
    """Dense and sparse groups, several rounds of sums, hot words, ties, a word in several languages."""
    if small:  # everything that depends on sizes at its smallest; values go to the workers inside the functions
        monkeypatch.setattr(co, "FAN", 3)
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["THE", "the", "É", "é", "a b", "\x00", "x" * 300, "\U0001f600", "￿"]
    rows = []
    for k in range(120):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ", ", "\n", "\x0c", "\x1c"]) for _ in range(rnd.randint(0, 60)))
        rows.append((k % 50, text + " the the the the", rnd.choice(["en", "de", None, "und", ""]), "s", 1))
    docs = spark.createDataFrame(rows + rows[:20], DOCUMENTS)
    got = co.collocations(docs, min_count=3, top=30, chunk_bytes=200 if small else co.CHUNK_BYTES)
    assert result(got) == brute([(r[1], r[2]) for r in rows + rows[:20]], 3, 30)


def test_counts_beyond_the_head(spark):
    """More words and pairs than dense tiles have places for."""
    words = [f"{i:04d}" for i in range(co.HEAD + 600)]
    texts = [" ".join(words[i:i + 3]) for i in range(0, len(words) - 2, 2) for _ in range(2)]
    rows = list(enumerate(texts))
    got = co.collocations(documents(spark, rows), min_count=2, top=10 ** 6)
    assert result(got) == brute([(t, "en") for t in texts], 2, 10 ** 6)


def test_groups_and_sums():
    left, right = np.array([0, 255, 256, 2047, 2048, 5]), np.array([0, 255, 0, 2047, 1, 9999])
    width = 10_000
    groups = co._groups(left, right, left * width + right, 7)
    assert groups[:4].tolist() == [0, 0, co.SIDE, co.SIDE * co.SIDE - 1] and (groups[4:] >= co.SIDE * co.SIDE).all()
    for grp in (0, co.SIDE, 100):
        codes = (left + 0) * width + right
        own = codes[groups == grp] if grp < 64 else codes[4:]
        twice, sums = co._sum_group(grp, width, [(own, np.ones(len(own), np.int64)), (own, np.full(len(own), 2 ** 40))])
        assert sorted(twice.tolist()) == sorted(own.tolist()) and (sums == 2 ** 40 + 1).all()


def test_score_is_exact(spark):
    rows = [(10, 11, 12), (7, 7, 7), (99_999_999_999_999, 99_999_999_999_999, 99_999_999_999_998), (3_000_000_000, 9_000_000_001, 4_000_000_003)]
    rows = [(a, max(a, l), max(a, r)) for a, l, r in rows]
    got = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", co.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(r.s == 10 ** 6 * r.a * r.a // (r.l * r.r) for r in got)


def test_odd_rows_and_clashing_columns(spark):
    docs = documents(spark, ODD * 6, extra=True).withColumns({c: F.lit(1) for c in ("word", "chunk", "grp", "id", "a", "n", "phrase", "pos")})
    assert result(co.collocations(docs, min_count=2)) == brute([(t[1], "en") for t in ODD * 6], 2)


def test_nothing_to_find(spark):
    assert co.collocations(documents(spark, [])).collect() == []
    assert co.collocations(documents(spark, [(1, None), (2, "a b c"), (None, "")])).collect() == []
