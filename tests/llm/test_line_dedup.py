import pathlib
import random
import time

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import line_dedup

from .helpers import ODD, documents, table


def brute(docs, least=5, size=5, threshold=0.8):
    """(doc, line) of the removed lines of [(doc_id, text)], by comparing all pairs of different lines."""
    first, places = {}, []
    for doc, text in sorted(docs):
        for no, line in enumerate((text or "").split("\n") if text is not None else []):
            line = line.strip(" ")
            if len(line.split(" ")) >= least:
                first.setdefault(line, (doc, no))
                places.append((doc, no, line))
    sets = {}
    for line in first:
        words = line.split(" ")
        sets[line] = {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}
    late, lines = set(), sorted(first, key=first.get)
    for i, b in enumerate(lines):
        for a in lines[:i]:
            common = len(sets[a] & sets[b])
            if common and common >= threshold * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                late.add(b)
                break
    return {(d, n) for d, n, line in places if line in late or first[line] != (d, n)}


def found(docs, **options):
    return {(r.doc_id, r.line_no) for r in line_dedup.removed_lines(docs, **options).collect()}


def variants(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(4, 70))] for _ in range(25)]
    docs = []
    for k in range(120):
        lines = []
        for _ in range(rng.randint(0, 4)):
            words = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(words))
                words[at:at + rng.choice([0, 1])] = [rng.choice(vocabulary)]
            lines.append(rng.choice(["", "  "]) + " ".join(words))
        docs.append((k, "\n".join(lines)))
    return docs


@pytest.mark.parametrize("buckets", [4, 1 << 16])
def test_against_brute_force_on_variants(spark, buckets):
    docs = variants(3)
    expected = brute(docs)
    assert len(expected) > 60
    assert found(documents(spark, docs), buckets=buckets) == expected


def test_other_thresholds_and_sizes(spark):
    docs = variants(4)
    for threshold, size in ((0.5, 2), (1.0, 5), (0.9, 3)):
        assert found(documents(spark, docs), threshold=threshold, shingle=size) == brute(docs, size=size, threshold=threshold)


def test_given_table(spark):
    docs = table(spark, "documents")
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_shuffled_fetch_of_candidates(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 0)
    docs = variants(5)
    assert found(documents(spark, docs)) == brute(docs)


def test_texts_and_odd_rows(spark):
    same = "one line of more than five words"
    rows = ODD + [(20, f"{same}\n\n  {same}\nshort\n{same} and its tail"), (21, f"first\n{same}")]
    out = line_dedup.dedup_lines(documents(spark, rows).select("doc_id", "text", "lang"))
    assert out.columns == ["doc_id", "text", "lang", "removed"]
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append((r.text, list(r.removed)))
    assert got[20] == [(f"{same}\n\nshort\n{same} and its tail", [2])] and got[21] == [("first", [1])]
    assert got[1] == [(None, [])] and got[2] == [("", [])] and len(got[5]) == 2
    assert got[4][0][1] == [] and got[5][0] == ("", [0])
    assert got[None] == [("a row without an id", [])]


def test_empty_table(spark):
    assert line_dedup.dedup_lines(documents(spark, []).select("doc_id", "text")).collect() == []


def test_rows_that_share_an_id_or_have_none(spark):
    same, near = "a line that many rows may have in common", "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, f"{same}\nthe last words of document number one"), (None, f"{same}\nonly the first row without an id says this"),
            (None, "only the second row without an id says this"), (7, f"{same}\nonly the first row of number seven says this"),
            (7, "only the second row of number seven says this"), (8, "both rows of number eight say this here\nfirst"),
            (8, "both rows of number eight say this here\nsecond"), (9, near), (9, f"{near} thirteen"), (6, "this row is there two times"),
            (6, "this row is there two times")]
    out = [(r.doc_id, r.text, list(r.removed)) for r in line_dedup.dedup_lines(documents(spark, rows).select("doc_id", "text")).collect()]
    left = {k: sorted(t for d, t, _ in out if d == k) for k in (1, 6, 7, 9, None)}
    assert left[1] == [rows[0][1]] and left[6] == ["this row is there two times"] * 2
    assert left[None] == ["only the first row without an id says this", "only the second row without an id says this"]
    assert left[7] == ["only the first row of number seven says this", "only the second row of number seven says this"]
    eight = sorted(r for d, _, r in out if d == 8)
    assert eight == [[], [0]]  # one of the two is the first
    assert len(left[9]) == 2 and left[9][0] == "" and left[9][1] in (near, f"{near} thirteen")


def prefix_sets(docs, sizes=None):
    lines = line_dedup.line_table(docs, 5)
    return line_dedup.different_lines(line_dedup.prefixes(lines, sizes or line_dedup.rarity(lines, 5, 1 << 16), 5, 0.8))


def test_postings_are_shuffled_once(spark):
    sets = prefix_sets(documents(spark, variants(6)))
    pairs = line_dedup.candidate_pairs(sets, spark.createDataFrame([], "h1 long"), 0.8)
    assert pairs.count() > 0
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # a reused exchange is printed with the exchange that it stands for
    assert "ReusedExchange" in plan and plan.count("hashpartitioning(token#") - plan.count("ReusedExchange") == 1


def test_lines_are_merged_and_common_tokens_come_last(spark):
    rng = random.Random(8)
    tail = " ".join(f"t{i}" for i in range(14))
    docs = [(k, " ".join(rng.choice("abcdefgh") + str(rng.randrange(10 ** 6)) for _ in range(rng.randint(30, 40))) + " " + tail) for k in range(200)]
    docs += [(1000 + k, docs[k][1]) for k in range(40)]
    by_hash, rarest = (prefix_sets(documents(spark, docs), sizes).collect() for sizes in (bytes(1), None))

    def most(sets):
        counts = {}
        for r in sets:
            for t in r.prefix:
                counts[t] = counts.get(t, 0) + 1
        return max(counts.values())
    assert len(rarest) == 200 and sorted(r.copies for r in rarest) == [1] * 160 + [2] * 40
    assert all(r.doc_id < 200 and len(r.prefix) == r.n - -(-r.n * 4 // 5) + 1 for r in rarest)
    assert most(by_hash) > 20 and most(rarest) == 1


def test_lines_with_a_common_phrase_are_no_candidates(spark):
    rng = random.Random(9)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(10 ** 6))
    phrase = [word() for _ in range(8)]
    docs = [(k, " ".join([*phrase, *(word() for _ in range(rng.randint(4, 6)))])) for k in range(150)]
    near = [(1000 + k, f"{docs[k][1]} {word()}") for k in range(30)]
    sets = prefix_sets(documents(spark, docs + near), bytes(1))  # without rarities, the phrase is in the prefixes
    known = spark.createDataFrame([], "h1 long")
    place = {r.h1: r.doc_id for r in sets.collect()}
    pairs = {frozenset((place[r.a1], place[r.b1])) for r in line_dedup.candidate_pairs(sets, known, 0.8).collect()}
    similar = {frozenset((k, 1000 + k)) for k in range(30)}
    late = {k - 1000 for k, _ in brute(docs + near)}
    assert late == set(range(30)) and similar <= pairs and len(pairs) < 200
    leaders = {frozenset((place[r.a1], place[r.b1])) for r in line_dedup.leader_pairs(sets, 0.8).collect()}
    assert len(leaders) < 60


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_parities_pass_all_similar_lines(spark, threshold):
    rng = random.Random(10)
    some = lambda n: [rng.getrandbits(64) - (1 << 63) for _ in range(n)]
    rows = []
    for _ in range(400):
        a = some(rng.choice([1, 2, 5, 20, 60, 300]))
        b = [*a[rng.randrange(rng.choice([len(a) // 3, len(a)]) + 1):], *some(rng.randrange(len(a) // 4 + 2))]
        rows.append((a, b, len(set(a) & set(b)) >= threshold * len(set(a) | set(b)) - 1e-9))
    frame = spark.createDataFrame(rows, "a array<long>, b array<long>, similar boolean")
    passed = line_dedup._near(threshold, F.size("a"), line_dedup._parity(F.col("a")), F.size("b"), line_dedup._parity(F.col("b")))
    found = [(r.similar, r.passed) for r in frame.select("similar", passed.alias("passed")).collect()]
    assert (True, False) not in found
    assert (True, True) in found and (False, False) in found


def test_shuffle_files_go_with_their_queries(spark):
    folders = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {p.name for d in folders for p in pathlib.Path(d).rglob("shuffle_*")}
    before, key = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key, None)
    docs = documents(spark, variants(11))
    gone = line_dedup.removed_lines(docs)  # what is left to run is lazy
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(key, None) == setting
    assert {(r.doc_id, r.line_no) for r in gone.collect()} == brute(variants(11))
