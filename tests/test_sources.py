import os

from pyspark.sql import functions as F

from tidewatch.operators.ordinal import with_ordinal
from tidewatch.schemas import ROSTER
from tidewatch.sources import files as fs
from tidewatch.streaming import weekly_ingest as wi


def test_upsert_second_batch_wins_and_is_idempotent(spark):
    a = spark.createDataFrame([(1, "old", 1.0), (2, "keep", 2.0)], "k int, v string, x double")
    b = spark.createDataFrame([(1, "new", None)], "k int, v string, x double")
    once = fs.upsert(a, b, ["k"])
    got = {r.k: (r.v, r.x) for r in once.collect()}
    assert got == {1: ("new", None), 2: ("keep", 2.0)}
    twice = {r.k: (r.v, r.x) for r in fs.upsert(once, b, ["k"]).collect()}
    assert twice == got


def test_csv_round_trip_and_versions(spark, scratch):
    df = spark.createDataFrame([("Byte", "leader", "grey", "sparkling", "team", 28, 432)], ROSTER)
    fs.write_csv(df, f"{scratch}/roster")
    back = fs.read_csv(spark, f"{scratch}/roster", ROSTER)
    assert back.collect() == df.collect()
    p = fs.write_version(df, f"{scratch}/table")
    assert fs.read_table(spark, p).count() == 1


def test_random_table_changes_with_seed(spark):
    a = fs.random_table(spark, 1).collect()
    b = fs.random_table(spark, 2).collect()
    assert len(a) == 10 and len(a[0]) == 5 and a != b
    assert all(0 <= v < 1 for r in a for v in r)


def test_ordinal_dense_over_partitions(spark):
    df = spark.range(0, 500).select(((F.col("id") * 7919) % 500).alias("v")).repartition(7)
    got = with_ordinal(df, ["v"]).collect()
    assert sorted((r.ordinal, r.v) for r in got) == [(i, i) for i in range(500)]


def test_streaming_ingest_upserts(spark, scratch):
    land = f"{scratch}/landing"
    os.makedirs(land)
    with open(f"{land}/w1.json", "w") as fh:
        fh.write('{"year": 2020, "week": 2, "localities": [{"localityNo": 1, "localityWeekId": 10, "name": "A"},'
                 ' {"localityNo": 2, "localityWeekId": 11, "name": "B"}]}')
    q = wi.start_ingest(spark, land, f"{scratch}/table", f"{scratch}/ckpt", once=True)
    q.awaitTermination(120)
    with open(f"{land}/w2.json", "w") as fh:
        fh.write('{"year": 2020, "week": 2, "localities": [{"localityNo": 1, "localityWeekId": 10, "name": "A2"}]}')
    q = wi.start_ingest(spark, land, f"{scratch}/table", f"{scratch}/ckpt", once=True)
    q.awaitTermination(120)
    cur = {r.localityweekid: r.name for r in wi.read_current(spark, f"{scratch}/table").collect()}
    assert cur == {10: "A2", 11: "B"}


def test_upsert_sink_replay_is_a_no_op(spark, scratch):
    root = f"{scratch}/keyed"
    sink = wi.upsert_sink(root, ["k"])
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    sink(first, 0)
    sink(spark.createDataFrame([(1, "replayed")], "k int, v string"), 0)   # same epoch again
    assert {r.k: r.v for r in wi.read_current(spark, root).collect()} == {1: "a", 2: "b"}
    sink(spark.createDataFrame([(2, "c")], "k int, v string"), 1)
    assert {r.k: r.v for r in wi.read_current(spark, root).collect()} == {1: "a", 2: "c"}


def test_upsert_ties_in_a_batch_have_one_winner(spark):
    rows = [(1, "b", 1.0), (1, "c", None), (1, "a", 9.0)]
    for n in (1, 3):
        batch = spark.createDataFrame(rows, "k int, v string, x double").repartition(n)
        assert [tuple(r) for r in fs.upsert(None, batch, ["k"]).collect()] == [(1, "c", None)]


def test_published_version_is_found_and_the_old_one_stays(spark, scratch):
    root = f"{scratch}/published"
    first = fs.publish(spark.range(3).toDF("id"), root)
    table = fs.read_published(spark, root)
    fs.publish(table.where("id > 0"), root)
    assert fs.read_published(spark, root).count() == 2 and spark.read.parquet(first).count() == 3


def test_landed_documents_are_read_by_their_schemas(spark, scratch):
    def landed(*texts):
        return fs.land(spark.createDataFrame([(t,) for t in texts], "json string"), scratch)
    s = fs.read_summaries(spark, landed('{"year": 2020, "week": 3, "localities": [{"localityNo": 7, "name": "A"}]}'), multiline=False).first()
    assert (s.year, s.week, s.localities[0].localityNo, s.localities[0].lat) == (2020, 3, 7, None)
    d = fs.read_details(spark, landed('{"localityName": "A", "localityWeek": {"avgMobileLice": 0.5}}'), multiline=False).first()
    assert d.localityName == "A" and d.localityWeek.avgMobileLice == 0.5
    o = fs.read_observations(spark, landed('{"data": [{"sourceId": "SN1", "referenceTime": "2020-01-01T00:00:00.000Z", "observations": []}]}'),
                             multiline=False).first()
    assert o.data[0].sourceId == "SN1"
    with open(f"{scratch}/pretty.json", "w") as fh:
        fh.write('{"year": 2021,\n "week": 4,\n "localities": []}')
    assert fs.read_summaries(spark, f"{scratch}/pretty.json").first().week == 4


def test_list_text_of_csv_cells(spark):
    cells = ["['Laks', 'Ørret']", '["Laks"]', "[]", None, "Laks"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    assert [r[0] for r in df.select(fs.parse_list_text(F.col("c"))).collect()] == [["Laks", "Ørret"], ["Laks"], [], None, []]


def test_broken_documents_go_to_quarantine(spark, scratch):
    texts = ['{"year": 2020, "week": 3, "localities": []}', '{"year": 2020, "week": 3, "loc', '{"week": 4}', '{"year": "soon", "week": 5}',
             "no json at all", '{"year": 2021, "week": 1, "localities": [{"localityNo": "seven"}]}', '{"year": 2022, "week": 2, "other": 1}']
    path = fs.land(spark.createDataFrame([(t, k % 2) for k, t in enumerate(texts)], "json string, part int"), scratch, ["part"])
    good, rejected = fs.split_documents(spark, path, wi.SUMMARY_DOC, ["year", "week"])
    assert {(r.year, r.week, r.part) for r in good.collect()} == {(2020, 3, 0), (2022, 2, 0)}
    got = {r.record: r.reason for r in rejected.collect()}
    assert len(got) == 5 and got[texts[1]] == got[texts[3]] == got[texts[4]] == got[texts[5]] == fs.BROKEN
    assert [v for k, v in got.items() if v != fs.BROKEN] == ["without year"]
    assert all("landed-" in r.file for r in rejected.collect())


def test_newest_document_of_a_week(spark):
    rows = [(2020, 1, 0, "first"), (2020, 1, 2, "third"), (2020, 1, 1, "second"), (2020, 2, 0, "a"), (2020, 2, 0, "b"), (None, 2, 0, "x")]
    df = spark.createDataFrame(rows, "year int, week int, fetch int, body string").repartition(3)
    got = {(r.year, r.week): r.body for r in fs.newest_documents(df, ["year", "week"], ["fetch"]).collect()}
    assert got == {(2020, 1): "third", (2020, 2): "b", (None, 2): "x"}
