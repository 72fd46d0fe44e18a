import __spark_entry__ as entry

from tidewatch.plans.catalog import COVERAGE, REGISTRY


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["municipalityno", "referencetime"]


def test_every_query_has_coverage_and_sql_keys_are_registered():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(REGISTRY) <= set(qs)
    assert all(COVERAGE[k] for k in REGISTRY)


def test_all_queries_run_in_full_on_smoke_data(spark):
    for name in REGISTRY:
        df = entry.queries()[name](spark, "/root/testdata/sf0.001")
        df.write.format("noop").mode("overwrite").save()
