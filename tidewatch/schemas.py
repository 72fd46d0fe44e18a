"""Explicit schemas for every entity and landed document (no inference in jobs)."""

from __future__ import annotations

from pyspark.sql import types as T

# The four daily weather elements requested from the observation service.
ELEMENT_AIR = "mean(air_temperature P1D)"
ELEMENT_PRECIPITATION = "sum(precipitation_amount P1D)"
ELEMENT_WIND = "mean(wind_speed P1D)"
ELEMENT_HUMIDITY = "mean(relative_humidity P1D)"
ELEMENTS = [ELEMENT_AIR, ELEMENT_PRECIPITATION, ELEMENT_WIND, ELEMENT_HUMIDITY]

# Element id -> combined-table column name.
ELEMENT_COLUMNS = {
    ELEMENT_AIR: "mean_air_temperature",
    ELEMENT_HUMIDITY: "mean_relative_humidity",
    ELEMENT_WIND: "mean_wind_speed",
    ELEMENT_PRECIPITATION: "sum_precipitation_amount",
}
MEAN_ELEMENTS = [ELEMENT_AIR, ELEMENT_HUMIDITY, ELEMENT_WIND]
SUM_ELEMENTS = [ELEMENT_PRECIPITATION]

LICE_COLUMNS = ["avgadultfemalelice", "avgmobilelice", "avgstationarylice"]
COMBINED_METRICS = ["mean_air_temperature", "mean_relative_humidity", "mean_wind_speed",
                    "sum_precipitation_amount", "avgadultfemalelice", "avgmobilelice",
                    "avgstationarylice", "seatemperature"]

# Alert thresholds per metric.
THRESHOLDS = {
    "mean_air_temperature": 20.0,
    "mean_relative_humidity": 100.0,
    "mean_wind_speed": 15.0,
    "sum_precipitation_amount": 130.0,
    "avgadultfemalelice": 0.9,
    "avgmobilelice": 3.0,
    "avgstationarylice": 0.7,
    "seatemperature": 17.0,
}

LOCALITY_STRUCT = T.StructType([
    T.StructField("localityNo", T.LongType()),
    T.StructField("localityWeekId", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("hasReportedLice", T.BooleanType()),
    T.StructField("isFallow", T.BooleanType()),
    T.StructField("avgAdultFemaleLice", T.DoubleType()),
    T.StructField("hasCleanerfishDeployed", T.BooleanType()),
    T.StructField("hasMechanicalRemoval", T.BooleanType()),
    T.StructField("hasSubstanceTreatments", T.BooleanType()),
    T.StructField("hasPd", T.BooleanType()),
    T.StructField("hasIla", T.BooleanType()),
    T.StructField("municipalityNo", T.IntegerType()),
    T.StructField("municipality", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("isOnLand", T.BooleanType()),
    T.StructField("inFilteredSelection", T.BooleanType()),
    T.StructField("hasSalmonoids", T.BooleanType()),
    T.StructField("isSlaughterHoldingCage", T.BooleanType()),
])

# Weekly summary document {year, week, localities: [...]}
SUMMARY_DOC = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("localities", T.ArrayType(LOCALITY_STRUCT)),
])

# Detailed locality-week document
DETAIL_DOC = T.StructType([
    T.StructField("localityNo", T.LongType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("localityName", T.StringType()),
    T.StructField("localityWeek", T.StructType([
        T.StructField("avgAdultFemaleLice", T.DoubleType()),
        T.StructField("avgMobileLice", T.DoubleType()),
        T.StructField("avgStationaryLice", T.DoubleType()),
        T.StructField("seaTemperature", T.DoubleType()),
    ])),
    T.StructField("aquaCultureRegister", T.StructType([
        T.StructField("speciesList", T.ArrayType(T.StringType())),
    ])),
])

# S3: weather observation document {data: [{sourceId, referenceTime, observations: [...]}]}
OBSERVATION_DOC = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("sourceId", T.StringType()),
        T.StructField("referenceTime", T.StringType()),
        T.StructField("observations", T.ArrayType(T.StructType([
            T.StructField("elementId", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("unit", T.StringType()),
            T.StructField("timeOffset", T.StringType()),
        ]))),
    ]))),
])

WEATHER_LONG = T.StructType([
    T.StructField("sourceid", T.StringType()),
    T.StructField("referencetime", T.TimestampType()),
    T.StructField("elementid", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("timeoffset", T.StringType()),
])

LICE_COUNTS = T.StructType([
    T.StructField("avgadultfemalelice", T.DoubleType()),
    T.StructField("avgmobilelice", T.DoubleType()),
    T.StructField("avgstationarylice", T.DoubleType()),
    T.StructField("seatemperature", T.DoubleType()),
    T.StructField("localityname", T.StringType()),
    T.StructField("specieslist", T.ArrayType(T.StringType())),
    T.StructField("year_week", T.DateType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
])

ROSTER = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("feather_color", T.StringType()),
    T.StructField("eye_color", T.StringType()),
    T.StructField("specialty", T.StringType()),
    T.StructField("length_cm", T.IntegerType()),
    T.StructField("weight_g", T.IntegerType()),
])

# Reference keys of the keyed tables (they omit the locality/station; ours add it).
KEYS = {
    "fish_table_year": ["localityweekid"],
    "lice_count_table": ["municipalityno", "year_week"],
    "weather_table": ["sourceid", "elementid", "timeoffset", "referencetime"],
    "combine_table": ["municipalityno", "referencetime"],
}
