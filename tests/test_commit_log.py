import threading

import pytest

from tidewatch.sources import commit_log as cl


def _rows(spark, rows):
    return spark.createDataFrame(rows, "k int, w int, v string")


def _state(spark, root, version=None):
    return {(r.k, r.w): r.v for r in cl.read(spark, root, version).collect()}


def test_merge_rewrites_touched_buckets_only(spark, scratch):
    root = f"{scratch}/t"
    cl.merge(_rows(spark, [(k, k % 4, "old") for k in range(40)]), root, ["k", "w"], buckets=32, bucket_by=["w"])
    before = cl.manifest(spark, root)[1]["paths"]
    cl.merge(_rows(spark, [(1, 1, "new"), (101, 1, "added")]), root, ["k", "w"])
    after = cl.manifest(spark, root)[1]["paths"]
    assert len(before) >= 2 and {b for b in after if after[b] != before.get(b)} == {b for b in after if "w=" not in b and after[b] not in before.values()}
    assert sum(after[b] != before[b] for b in before) == 1
    got = _state(spark, root)
    assert len(got) == 41 and got[(1, 1)] == "new" and got[(101, 1)] == "added" and got[(5, 1)] == "old"


def test_reader_between_two_commits_keeps_its_version(spark, scratch):
    root = f"{scratch}/t"
    assert cl.read(spark, root) is None
    cl.merge(_rows(spark, [(1, 0, "a"), (2, 0, "b")]), root, ["k"], buckets=2)
    reader = cl.read(spark, root)  # opened before, read after the next commit
    cl.merge(_rows(spark, [(1, 0, "c")]), root, ["k"])
    assert {r.k: r.v for r in reader.collect()} == {1: "a", 2: "b"}
    assert _state(spark, root) == {(1, 0): "c", (2, 0): "b"} and _state(spark, root, 0) == {(1, 0): "a", (2, 0): "b"}


def test_a_writer_that_dies_before_its_commit_leaves_nothing(spark, scratch, monkeypatch):
    root = f"{scratch}/t"
    cl.merge(_rows(spark, [(1, 0, "a")]), root, ["k"], buckets=2)
    with monkeypatch.context() as m:
        m.setattr(cl, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            cl.merge(_rows(spark, [(1, 0, "b")]), root, ["k"])
    assert _state(spark, root) == {(1, 0): "a"} and cl.versions(spark, root) == [0]


def test_one_of_two_writers_wins_and_the_other_merges_again(spark, scratch):
    root = f"{scratch}/t"
    cl.merge(_rows(spark, [(0, 0, "start")]), root, ["k"], buckets=2)
    content = cl.manifest(spark, root)[1]
    cl.commit(spark, root, 1, content)
    with pytest.raises(cl.CommitConflict):
        cl.commit(spark, root, 1, content | {"paths": {}})
    threads = [threading.Thread(target=cl.merge, args=(_rows(spark, [(k, 0, f"w{k}")]), root, ["k"])) for k in (1, 2, 3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert _state(spark, root) == {(0, 0): "start", (1, 0): "w1", (2, 0): "w2", (3, 0): "w3"}
    assert cl.versions(spark, root) == [0, 1, 2, 3, 4]


def test_null_keys_ties_empty_batches_and_sequences(spark, scratch):
    root = f"{scratch}/t"
    cl.merge(_rows(spark, [(None, 0, "a"), (1, 0, "x"), (1, 0, "y")]), root, ["k"], buckets=4)
    assert _state(spark, root) == {(None, 0): "a", (1, 0): "y"}
    cl.merge(_rows(spark, [(None, 0, "b")]), root, ["k"])
    cl.merge(_rows(spark, []), root, ["k"])
    assert _state(spark, root) == {(None, 0): "b", (1, 0): "y"}
    batch = spark.createDataFrame([(1, 0, "late", 1), (1, 0, "early", 2)], "k int, w int, v string, n int")
    cl.merge(batch, root, ["k"], seq_col="n")
    assert _state(spark, root)[(1, 0)] == "early"
    with pytest.raises(ValueError):
        cl.merge(batch, root, ["k"], bucket_by=["w"])


def test_an_empty_table_has_its_columns(spark, scratch):
    root = f"{scratch}/t"
    cl.merge(_rows(spark, []), root, ["k"])
    assert cl.read(spark, root).columns == ["k", "w", "v"] and cl.read(spark, root).count() == 0


def test_a_transaction_is_applied_once(spark, scratch):
    root = f"{scratch}/t"
    for value in ("a", "b"):
        cl.merge(_rows(spark, [(1, 0, value)]), root, ["k"], txn=("job", 7))
    assert _state(spark, root) == {(1, 0): "a"} and len(cl.versions(spark, root)) == 1
