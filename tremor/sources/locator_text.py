"""Results of an external locator: hypocentre-phase text (``.hyp``), blocks of tagged lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Blocks that a task splits at once begin with this word.
BEGIN, PHASES, END = "NLLOC ", "PHASE ", "END_PHASE"


def _blocks(spark: SparkSession, path) -> DataFrame:
    """The lines of each location, wherever it lies in whichever file; files may hold one or many."""
    text = spark.read.option("lineSep", "END_NLLOC").text(path)  # a record is a block, so a large file is split
    lines = F.filter(F.split("value", "\r?\n"), lambda x: F.trim(x) != "")
    return text.select(lines.alias("lines")).where(F.exists("lines", lambda x: x.startswith(BEGIN)))


def _tagged(tag: str) -> Column:
    """The words of the first line with a tag."""
    return F.split(F.trim(F.get(F.filter("lines", lambda x: x.startswith(tag + " ")), F.lit(0))), r"\s+")


def _after(tag: str, name: str, kind: str = "double") -> Column:
    """The word behind a name in a tagged line."""
    words = _tagged(tag)
    return F.get(words, F.array_position(words, name).cast("int")).try_cast(kind)


def _stamp(words: Column, at: int) -> Column:
    """Microseconds of year, month, day, hour, minute and second; a second of 60 or more goes on into the next minute."""
    part = lambda k: F.get(words, F.lit(at + k))
    minute = F.try_to_timestamp(F.concat_ws(" ", *[F.lpad(part(k), 4 if k == 0 else 2, "0") for k in range(5)]), F.lit("yyyy MM dd HH mm"))
    return F.unix_micros(minute) + F.round(part(5).try_cast("double") * 1000000).cast("long")


def read_locations(spark: SparkSession, path) -> DataFrame:
    """A row per location: signature, status, origin, errors and quality; what a block lacks is null."""
    b = _blocks(spark, path)
    first = F.filter("lines", lambda x: x.startswith(BEGIN))
    head = F.regexp_extract_all(F.get(first, F.lit(0)), F.lit('"([^"]*)"'), F.lit(1))
    geo = _tagged("GEOGRAPHIC")
    return b.select(
        F.get(head, F.lit(0)).alias("location_id"), F.get(head, F.lit(1)).alias("status"),
        F.timestamp_micros(_stamp(geo, 2)).alias("origin_time"),
        _after("GEOGRAPHIC", "Lat").alias("latitude"), _after("GEOGRAPHIC", "Long").alias("longitude"), _after("GEOGRAPHIC", "Depth").alias("depth_km"),
        _after("QUALITY", "RMS").alias("rms"), _after("QUALITY", "Nphs", "int").alias("n_phases"), _after("QUALITY", "Gap").alias("gap"), _after("QUALITY", "Dist").alias("nearest_km"),
        *[F.sqrt(_after("STATISTICS", k)).alias(f"error_{n}_km") for k, n in (("CovXX", "x"), ("YY", "y"), ("ZZ", "z"))],
        F.size(_phase_lines()).alias("n_lines"),
    )


def _phase_lines() -> Column:
    """What lies between PHASE and END_PHASE."""
    begin = F.array_position(F.transform("lines", lambda x: x.startswith(PHASES)), True).cast("int")
    end = F.array_position(F.transform("lines", lambda x: x.startswith(END)), True).cast("int")
    return F.when((begin > 0) & (end > begin), F.slice("lines", begin + 1, end - begin - 1)).otherwise(F.array().cast("array<string>"))


def read_phases(spark: SparkSession, path) -> DataFrame:
    """A row per phase of each location: station, phase, pick time and error, and behind ``>`` travel time, residual, weight, distance and azimuth."""
    first = F.filter("lines", lambda x: x.startswith(BEGIN))
    name = F.get(F.regexp_extract_all(F.get(first, F.lit(0)), F.lit('"([^"]*)"'), F.lit(1)), F.lit(0))
    rows = _blocks(spark, path).select(name.alias("location_id"), F.posexplode(_phase_lines()).alias("ord", "line"))
    sides = F.split("line", ">")
    left, right = F.split(F.trim(F.get(sides, F.lit(0))), r"\s+"), F.split(F.trim(F.get(sides, F.lit(1))), r"\s+")
    word = lambda c, k, kind="double": F.get(c, F.lit(k)).try_cast(kind)
    day, minute = word(left, 6, "string"), F.lpad(word(left, 7, "string"), 4, "0")
    at = F.unix_micros(F.try_to_timestamp(F.concat(day, F.lit(" "), minute), F.lit("yyyyMMdd HHmm"))) + F.round(word(left, 8) * 1000000).cast("long")
    return rows.select(
        "location_id", "ord", word(left, 0, "string").alias("station"), word(left, 4, "string").alias("phase"), F.timestamp_micros(at).alias("pick_time"), word(left, 10).alias("uncertainty"),
        word(right, 0).alias("travel_time"), word(right, 1).alias("time_residual"), word(right, 2).alias("time_weight"), word(right, 6).alias("distance_km"), word(right, 7).alias("azimuth"),
    )


def location_text(origin: dict, phases: list[dict]) -> str:
    """One location in the same text, as :func:`read_locations` and :func:`read_phases` take it."""
    t, out = origin["origin_time"], []
    out.append(f'NLLOC "{origin["location_id"]}" "{origin["status"]}" "Location completed."')
    out.append(f"GEOGRAPHIC  OT {t:%Y %m %d  %H %M} {t.second + t.microsecond / 1e6:.6f}  Lat {origin['latitude']:.6f} Long {origin['longitude']:.6f} Depth {origin['depth_km']:.6f}")
    out.append(f"QUALITY  Pmax 0 MFmin 0 MFmax 0 RMS {origin['rms']:.6f} Nphs {origin['n_phases']} Gap {origin['gap']:.3f} Dist {origin['nearest_km']:.4f} Mamp 0 0 Mdur 0 0")
    x, y, z = (origin[f"error_{k}_km"] ** 2 for k in "xyz")
    out.append(f"STATISTICS  ExpectX 0 Y 0 Z 0  CovXX {x:.6f} XY 0 XZ 0 YY {y:.6f} YZ 0 ZZ {z:.6f} EllAz1 0")
    out.append("PHASE ID Ins Cmp On Pha  FM Date     HrMn   Sec     Err  ErrMag    Coda      Amp       Per  >   TTpred    Res       Weight    StaLoc(X  Y         Z)        SDist    SAzim  RAz  RDip RQual    Tcorr")
    for p in phases:
        k = p["pick_time"]
        out.append(f"{p['station']:<6} ? ? ? {p['phase']:<6} ? {k:%Y%m%d %H%M} {k.second + k.microsecond / 1e6:9.6f} GAU {p['uncertainty']:9.2e} -1 -1 -1 > {p['travel_time']:9.4f} {p['time_residual']:9.4f} {p['time_weight']:9.4f} 0 0 0 {p['distance_km']:9.4f} {p['azimuth']:6.2f} 0 0 0 0")
    return "\n".join([*out, "END_PHASE", "END_NLLOC", "", ""])
