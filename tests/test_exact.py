"""Results do not depend on how the rows are dealt."""

import __spark_entry__ as entry

SMOKE = "/root/testdata/sf0.001"


def test_combine_weekly_is_the_same_for_any_partitioning(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            df = entry.queries()["combine_weekly"](spark, SMOKE)
            results.append(sorted(map(repr, df.collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert results[0] == results[1] and results[0]
