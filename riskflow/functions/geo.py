"""Great-circle distance as a native Column expression (stays inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from riskflow.constants import EARTH_RADIUS_MILES


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def miles_between(lat1, lon1, lat2, lon2) -> Column:
    """Haversine miles, NULL when any input is NULL.

    The haversine term is clamped to [0, 1] so rounding can never produce NaN (NaN >= 500 is true
    in Spark). The clamp is applied only to non-NULL terms: ``least``/``greatest`` skip NULLs and
    would otherwise turn a missing coordinate into 0 miles.
    """
    lat1, lon1, lat2, lon2 = (_c(v) for v in (lat1, lon1, lat2, lon2))
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2 - lat1)
    dlam = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(dlam / 2), 2)
    a = F.when(a.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), a)))
    return F.lit(EARTH_RADIUS_MILES) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def _haversine_sql() -> str:
    h = (
        "least(1D, greatest(0D, pow(sin(radians(lat2 - lat1) / 2), 2) + "
        "cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))"
    )
    return (
        "CREATE OR REPLACE TEMPORARY FUNCTION miles_between("
        "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE RETURN "
        "CASE WHEN lat1 IS NULL OR lon1 IS NULL OR lat2 IS NULL OR lon2 IS NULL THEN NULL "
        f"ELSE {EARTH_RADIUS_MILES}D * 2 * atan2(sqrt({h}), sqrt(1 - {h})) END"
    )


def register_sql_function(spark: SparkSession) -> None:
    """Register ``miles_between`` as a SQL-bodied function (inlined by the analyzer; no Python)."""
    spark.sql(_haversine_sql())
