"""Domain views derived by Spark from the supplied TPC-H-style tables.

The monitoring domain is laid onto the supplied tables so that every job reads
real, growing data:

=====================  ==================================================
domain entity          derived from
=====================  ==================================================
site (locality)        ``customer`` (+ ``nation`` as municipality)
weekly site summary    one ``orders`` row = one locality-week report
weather station        ``supplier`` (station id ``'SN' || s_suppkey``)
daily observation      ``lineitem`` unpivoted into the four weather elements
lice report            ``orders`` of a municipality aggregated per ISO week
roster (demo app)      ``part``
=====================  ==================================================

Every function returns a lazy DataFrame; column pruning and filters reach the
parquet scans. The equivalent DuckDB SQL of each view lives in
:mod:`tidewatch.plans.oracle` and must be kept in step with this file.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..schemas import ELEMENT_AIR, ELEMENT_HUMIDITY, ELEMENT_PRECIPITATION, ELEMENT_WIND

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Species names of the aquaculture register, keyed by order status.
SPECIES_BY_STATUS = {"F": "Laks", "O": "Ørret", "P": "Regnbueørret"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Keyed-table scan of one supplied parquet table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lat_of(acctbal) -> F.Column:
    # account balance [-1000, 10000) spread over latitudes 58..71 N
    return F.lit(58.0) + (acctbal + F.lit(1000.0)) / F.lit(11000.0) * F.lit(13.0)


def _lon_of(nationkey, key) -> F.Column:
    return F.lit(4.0) + nationkey.cast("double") * F.lit(0.5) + F.pmod(key, F.lit(10)).cast("double") / F.lit(10.0)


def _price(column: str) -> F.Column:
    """Money as an exact decimal, so that sums do not depend on the order of rows."""
    return F.col(column).cast("decimal(18,2)")


def _mean_price(amount: F.Column, unit: float) -> F.Column:
    """Mean of exact amounts in ``unit``s."""
    return F.sum(amount).cast("double") / F.nullif(F.count(amount), F.lit(0)) / F.lit(unit)


def localities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site catalogue: localityno, name, lat, lon, municipalityno, municipality."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias("localityno"), F.col("c_name").alias("name"),
                    _lat_of(F.col("c_acctbal")).alias("lat"),
                    _lon_of(F.col("c_nationkey"), F.col("c_custkey")).alias("lon"),
                    F.col("c_nationkey").alias("municipalityno"), F.col("n_name").alias("municipality")))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station catalogue (S4 input): sourceid, lat, lon, municipalityno."""
    s = table(spark, sf_dir, "supplier")
    return s.select(F.concat(F.lit("SN"), F.col("s_suppkey").cast("string")).alias("sourceid"),
                    _lat_of(F.col("s_acctbal")).alias("lat"),
                    _lon_of(F.col("s_nationkey"), F.col("s_suppkey")).alias("lon"),
                    F.col("s_nationkey").alias("municipalityno"))


def fish_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly site summaries (``fish_table_year``), one row per locality-week report."""
    o = table(spark, sf_dir, "orders")
    loc = localities(spark, sf_dir)
    od = cal.to_utc_timestamp_col("o_orderdate")
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    pending = st == F.lit("P")
    year, week = cal.iso_year(od), cal.iso_week(od)
    rows = (o.join(loc, o.o_custkey == loc.localityno, "inner")
            .select(
                F.col("localityno"),
                F.col("o_orderkey").alias("localityweekid"),
                F.col("name"),
                (~pending).alias("hasreportedlice"),
                pending.alias("isfallow"),
                # hundredths of 250000, halves up, in whole cents
                F.when(~pending, F.expr("(cast(cast(o_totalprice as decimal(18,2)) * 100 as bigint) + 125000) div 250000 / 100.0D"))
                .alias("avgadultfemalelice"),
                (pr == F.lit("3-MEDIUM")).alias("hascleanerfishdeployed"),
                (pr == F.lit("4-NOT SPECIFIED")).alias("hasmechanicalremoval"),
                (pr == F.lit("5-LOW")).alias("hassubstancetreatments"),
                F.when(~pending, pr == F.lit("1-URGENT")).alias("haspd"),
                (pr == F.lit("2-HIGH")).alias("hasila"),
                F.col("municipalityno"), F.col("municipality"), F.col("lat"), F.col("lon"),
                F.lit(False).alias("isonland"),
                F.lit(True).alias("infilteredselection"),
                F.lit(True).alias("hassalmonoids"),
                ((st == F.lit("F")) & (pr == F.lit("5-LOW"))).alias("isslaughterholdingcage"),
                year.alias("year"), week.alias("week")))
    return rows.withColumn("date", cal.monday_sunday_first("year", "week"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather observations in long form (``weather_table`` + ``municipalityno``).

    One lineitem yields four element rows; its supplier is the station and the
    supplier's nation the municipality the station serves.
    """
    j = readings(spark, sf_dir)
    return (j.select("municipalityno", station_of(F.col("l_suppkey")).alias("sourceid"),
                     cal.to_utc_timestamp_col("l_shipdate").alias("referencetime"),
                     time_offset_of(F.col("l_linenumber")).alias("timeoffset"),
                     F.inline(elements_of(F.col)))
            .select("municipalityno", "sourceid", "referencetime", "elementid", "value", "unit", "timeoffset"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the observations are made of, one row for the four of them: the lineitem's columns and ``municipalityno``."""
    li = table(spark, sf_dir, "lineitem")
    su = table(spark, sf_dir, "supplier")
    return li.join(su, li.l_suppkey == su.s_suppkey, "inner").select(
        F.col("s_nationkey").alias("municipalityno"), "l_suppkey", "l_shipdate", *READING)


#: columns of a lineitem that its observations differ in
READING = ["l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice"]


def station_of(suppkey: F.Column) -> F.Column:
    return F.concat(F.lit("SN"), suppkey.cast("string"))


def time_offset_of(linenumber: F.Column) -> F.Column:
    return F.concat(F.lit("PT"), linenumber.cast("string"), F.lit("H"))


def elements_of(of: Callable[[str], F.Column]) -> F.Column:
    """The four observations (elementid, value, unit) of a reading, whose columns ``of`` gives by name."""
    return F.array(
        F.struct(F.lit(ELEMENT_AIR).alias("elementid"),
                 (of("l_quantity") * 0.5 - 5.0).alias("value"), F.lit("degC").alias("unit")),
        F.struct(F.lit(ELEMENT_HUMIDITY).alias("elementid"),
                 (of("l_discount") * 500.0 + 50.0).alias("value"), F.lit("percent").alias("unit")),
        F.struct(F.lit(ELEMENT_WIND).alias("elementid"),
                 (of("l_tax") * 200.0).alias("value"), F.lit("m/s").alias("unit")),
        F.struct(F.lit(ELEMENT_PRECIPITATION).alias("elementid"),
                 (of("l_extendedprice") / 1000.0).alias("value"), F.lit("mm").alias("unit")),
    )


def lice_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detailed locality-week lice reports per municipality and ISO week (S2 content, flat)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    od = cal.to_utc_timestamp_col("o_orderdate")
    species = F.create_map(*[x for k, v in SPECIES_BY_STATUS.items() for x in (F.lit(k), F.lit(v))])
    base = (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .select(F.col("c_nationkey").alias("municipalityno"), cal.iso_year(od).alias("year"),
                    cal.iso_week(od).alias("week"), "o_totalprice", "o_orderstatus", "o_orderpriority"))
    prio = F.substring("o_orderpriority", 1, 1).cast("int")
    agg = (base.groupBy("municipalityno", "year", "week")
           .agg(_mean_price(F.when(F.col("o_orderstatus") != "P", _price("o_totalprice")).otherwise(0), 250000.0)
                .alias("avgadultfemalelice"),
                _mean_price(_price("o_totalprice"), 100000.0).alias("avgmobilelice"),
                _mean_price(F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), _price("o_totalprice"))
                            .otherwise(0), 500000.0).alias("avgstationarylice"),
                (F.avg(prio) * 3.0 + 2.0).alias("seatemperature"),
                F.array_sort(F.collect_set(species[F.col("o_orderstatus")])).alias("specieslist")))
    return agg.join(n.select(F.col("n_nationkey").alias("municipalityno"), F.col("n_name").alias("localityname")),
                    "municipalityno", "left")


def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("municipalityno"), F.col("n_name").alias("localityname"))


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demo roster: name, role, feather_color, eye_color, specialty, length_cm, weight_g."""
    p = table(spark, sf_dir, "part")
    words = F.split(F.col("p_name"), " ")
    return p.select(F.concat_ws(" ", F.col("p_name"), F.col("p_partkey").cast("string")).alias("name"),
                    F.col("p_type").alias("role"),
                    F.col("p_brand").alias("feather_color"),
                    F.element_at(words, 1).alias("eye_color"),
                    F.element_at(words, -1).alias("specialty"),
                    F.col("p_size").cast("int").alias("length_cm"),
                    F.floor("p_retailprice").cast("int").alias("weight_g"))
