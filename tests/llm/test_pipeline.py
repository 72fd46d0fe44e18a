import pathlib
import time

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import langid
from tidewatch.llm.queries import REGISTRY, SQL

from . import test_decontam, test_line_dedup, test_packing, test_simhash
from .helpers import SF, documents, table


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_against_brute_force(spark):
    """Every stage against a plain version of it, on what the stages before have kept."""
    docs = table(spark, "documents")
    profiles = langid.fit(docs)
    rows = {r.doc_id: r for r in docs.collect()}
    expected = {k: r.text for k, r in rows.items() if r.text and any(c.isalpha() for c in r.text)}
    assert profiles.languages
    removed = {}
    for doc, no in test_line_dedup.brute(list(expected.items())):
        removed.setdefault(doc, set()).add(no)
    kept = {}
    for k, text in expected.items():
        left = "\n".join(x for no, x in enumerate(text.split("\n")) if no not in removed.get(k, ()))
        if k not in removed or left.split():
            kept[k] = left
    prints = {k: test_simhash.brute_fingerprint(t) for k, t in kept.items()}
    ids = sorted(prints)
    near = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (prints[a] ^ prints[b]).bit_count() <= 4]
    roots = test_simhash.groups(near, ids)
    kept = {k: t for k, t in kept.items() if roots[k] == k}
    bench = [(r.item_id, r.text) for r in table(spark, "benchmark").collect()]
    verdicts = test_decontam.brute(list(kept.values()), bench)
    kept = {k: t for (k, t), v in zip(kept.items(), verdicts) if not v[4]}

    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SF)
        assert frame.columns == docs.columns and frame.dtypes == docs.dtypes, name
    got = {r.doc_id: r for r in frame.collect()}
    assert {k: r.text for k, r in got.items()} == kept
    assert all(r.n_chars == (len(r.text) if k in removed else rows[k].n_chars) for k, r in got.items())
    pieces = corpus_pipeline.run(spark, SF).collect()
    test_packing.check(pieces, dict(zip(kept, test_packing.ids_of(kept.values()))))


def test_odd_rows_pass_every_stage(spark):
    from .helpers import ODD
    frame = documents(spark, ODD)
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF)
    assert frame.count() > 0
    frame = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF)
    assert frame.count() == 0


@pytest.mark.parametrize("name", sorted(SQL, key=lambda n: int(n[2:].split("_")[0])))
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(SQL[name])
    columns = sorted(d[0] for d in found.description)
    rows = [dict(zip([d[0] for d in found.description], r)) for r in found.fetchall()]
    mine = REGISTRY[name](spark, SF)
    assert sorted(mine.columns) == columns
    plain = lambda r: tuple(round(r[c], 8) if isinstance(r[c], float) else r[c] for c in columns)
    assert sorted(map(repr, map(plain, rows))) == sorted(map(repr, (plain(r.asDict()) for r in mine.collect())))


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in REGISTRY} == {f"op{k}" for k in range(1, 14)}


def test_columns_of_any_name_pass_every_stage(spark):
    names = ["removed", "_removed", "_id", "_row", "_hits", "row", "n", "doc", "score", "fp", "line_no"]
    rows = [(k, f"line one of text {k} with more words\nthis line is in every text of them all\nshort") for k in range(6)]
    frame = documents(spark, rows).withColumns({c: F.col("doc_id") + 1 for c in names})
    columns = frame.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SF)
        assert frame.columns == columns
    got = frame.collect()
    assert got and all(r[c] == r.doc_id + 1 for r in got for c in names)
    assert corpus_pipeline.pack(spark, frame, SF).count() >= len(got)


def test_line_dedup_frees_the_shuffle_files_of_its_queries(spark):
    folders = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {p.name for d in folders for p in pathlib.Path(d).rglob("shuffle_*")}
    rows = [(k, f"line one of text {k} with more words\nthis line is in every text of them all") for k in range(6)]
    before = files()
    frame = corpus_pipeline.line_dedup_stage(spark, documents(spark, rows), SF)
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert {r.doc_id: r.text for r in frame.collect()} == {k: t if k == 0 else t.split("\n")[0] for k, t in rows}
