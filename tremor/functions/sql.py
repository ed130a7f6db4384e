"""The library's column expressions as functions of SQL.

Each is a temporary SQL function whose body is plain SQL, so Spark inlines it
into the plan; none calls Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tremor.functions.geo import EARTH_KM, KM_PER_DEGREE

_HAVERSINE = "pow(sin((radians(lat2) - radians(lat1)) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)"

#: Arguments, type and body of each function.
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "great_circle_degrees": ("lat1 double, lon1 double, lat2 double, lon2 double", "double", f"degrees(2 * asin(sqrt(least({_HAVERSINE}, 1.0D))))"),
    "great_circle_km": ("lat1 double, lon1 double, lat2 double, lon2 double", "double", f"radians(great_circle_degrees(lat1, lon1, lat2, lon2)) * {EARTH_KM}D"),
    "pseudo_time": ("seconds double, km double, velocity double", "double", "sqrt(seconds * seconds + (km / velocity) * (km / velocity))"),
    "km_to_degrees": ("km double", "double", f"km / {KM_PER_DEGREE}D"),
    "round_time": ("t timestamp", "timestamp", "timestamp_micros(cast(bround(cast(unix_micros(t) as decimal(20,0)) / 100, 0) * 100 as bigint))"),
    "phase_family": ("phase string", "string", "case when contains(phase, 'P') then 'P' when contains(phase, 'S') then 'S' end"),
    "first_letter": ("phase string", "string", "upper(substring(phase, 1, 1))"),
    "pick_uncertainty": ("phase string, p double, s double", "double", "case phase_family(phase) when 'P' then p when 'S' then s end"),
    "net_station": ("station_id string", "string", "substring_index(station_id, '.', 2)"),
    "used_arrival": ("weight double, residual double", "boolean", "coalesce(weight <> 0 and residual <> 0, false)"),
    "event_key": ("prefix string, t timestamp", "string", "concat(prefix, cast(year(t) as string), lower(conv(cast(unix_millis(t) as string), 10, 36)))"),
    "last_segment": ("uri string", "string", "substring_index(uri, '/', -1)"),
    "inside_ring": (
        "lon double, lat double, ring array<struct<lon: double, lat: double>>", "boolean",
        "aggregate(sequence(1, greatest(size(ring) - 1, 1)), 0, (n, i) -> n + case when i < size(ring) and (ring[i - 1].lat > lat) <> (ring[i].lat > lat)"
        " and lon < ring[i - 1].lon + (lat - ring[i - 1].lat) * (ring[i].lon - ring[i - 1].lon) / (ring[i].lat - ring[i - 1].lat) then 1 else 0 end) % 2 = 1",
    ),
}


def register(spark: SparkSession, prefix: str = "tremor_") -> list[str]:
    """Makes the functions known to a session under their names behind a prefix; returns those names."""
    import re

    for name, (arguments, kind, body) in FUNCTIONS.items():
        called = re.sub(rf"\b({'|'.join(FUNCTIONS)})\(", rf"{prefix}\1(", body)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({arguments}) RETURNS {kind} RETURN {called}")
    return [prefix + n for n in FUNCTIONS]
