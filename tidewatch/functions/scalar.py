"""Scalar column functions C10-C14 (all built-in expressions, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Region boundaries in degrees latitude and the unknown-region label.
REGION_SOUTH_BELOW = 63.81
REGION_NORTH_ABOVE = 68.85
REGION_UNKNOWN = "NaN"

# Roster note thresholds and texts.
BMI_OVERWEIGHT_AT = 5.2
DIVERSITY_MIN = 0.8
NOTE_OK = "+Acceptable"
NOTE_OVERWEIGHT = "-Overweight"
NOTE_NOT_DIVERSE = "-Not diverse"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def region_of_latitude(lat) -> Column:
    """South below 63.81, Middle up to 68.85 inclusive, North above; missing -> 'NaN'."""
    lat = _c(lat)
    return (F.when(lat < REGION_SOUTH_BELOW, F.lit("South"))
            .when(lat <= REGION_NORTH_ABOVE, F.lit("Middle"))
            .when(lat > REGION_NORTH_ABOVE, F.lit("North"))
            .otherwise(F.lit(REGION_UNKNOWN)))


def body_mass_index(weight_g, length_cm) -> Column:
    """C11: (g/1000) / (cm/100)^2; a zero length gives null instead of an error."""
    metres = _c(length_cm).cast("double") / 100.0
    return F.try_divide(_c(weight_g).cast("double") / 1000.0, metres * metres)


def round_half_even(c, digits: int = 0) -> Column:
    """banker's rounding (``round`` in Spark is half-up)."""
    return F.bround(_c(c), digits)


def bmi_note(rounded_bmi) -> Column:
    """C13: '-Overweight' at or above 5.2 (on the rounded value)."""
    return F.when(_c(rounded_bmi) >= BMI_OVERWEIGHT_AT, F.lit(NOTE_OVERWEIGHT)).otherwise(F.lit(NOTE_OK))


def diversity_note(rounded_diversity) -> Column:
    """C13: '-Not diverse' below 0.8 (on the rounded value)."""
    return F.when(_c(rounded_diversity) < DIVERSITY_MIN, F.lit(NOTE_NOT_DIVERSE)).otherwise(F.lit(NOTE_OK))


def as_text(c) -> Column:
    """C14: number -> string."""
    return _c(c).cast("string")


def join_text(cols, sep: str = ",") -> Column:
    """C14: join several columns (or one array column) with ``sep``."""
    if isinstance(cols, (list, tuple)):
        return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])
    return F.array_join(_c(cols), sep)
