"""Catalogue tables: arrivals, picks, origins and events, one row each, joined by ids."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.functions.geo import KM_PER_DEGREE, great_circle_km, inside_polygon
from tremor.operators.picks import micros
from tremor.session import materialize

DIGITS = "0123456789abcdefghijklmnopqrstuvwxyz"
#: Side of the cells by which points and zones meet.
CELL_DEGREES = 0.25


def used(weight: Column | None = None, residual: Column | None = None) -> Column:
    """Whether an arrival was used: weight and residual are neither null nor 0."""
    w = F.col("time_weight") if weight is None else weight
    r = F.col("time_residual") if residual is None else residual
    return w.isNotNull() & (w != 0) & r.isNotNull() & (r != 0)


def used_counts(arrivals: DataFrame, station: str = "station") -> DataFrame:
    """Used phases and distinct used stations of each event."""
    return arrivals.groupBy("event_id").agg(F.count_if(F.coalesce(used(), F.lit(False))).alias("used_phase_count"), F.count_distinct(F.when(used(), F.col(station))).alias("used_station_count"))


def stations_with_phases(arrivals: DataFrame, least: int, compat: bool = False) -> DataFrame:
    """Stations of each event with both a P-like and an S-like weighted arrival.

    ``compat`` counts stations with ``least`` weighted arrivals of any phase
    instead. Arrivals of weight 0 don't count, those without a weight do.
    """
    rows = arrivals.where("time_weight is null or time_weight <> 0")
    per = rows.groupBy("event_id", "station").agg(F.count("*").alias("n"), F.max(F.upper("phase").contains("P")).alias("p"), F.max(F.upper("phase").contains("S")).alias("s"))
    good = (F.col("n") >= least) if compat else (F.col("p") & F.col("s"))
    return per.groupBy("event_id").agg(F.count_if(good).alias("n_stations"))


def accept_events(arrivals: DataFrame, min_phase: int, min_both: int) -> DataFrame:
    """``event_id`` with both counts, of events with enough used phases and enough stations with several phases."""
    both = used_counts(arrivals).join(stations_with_phases(arrivals, min_both, compat=True), "event_id", "left")
    both = both.withColumn("n_stations", F.coalesce("n_stations", F.lit(0)))
    return both.where(f"used_phase_count >= {min_phase} and n_stations >= {min_both}").select("event_id", "used_phase_count", "n_stations")


def clean_arrivals(arrivals: DataFrame, p_limit: float | None = 0.40, s_limit: float | None = 0.75, km: float | None = None) -> DataFrame:
    """Arrivals with a weight (beyond 1e-3) whose residual and distance are within the limits; null or 0 switches a limit off.

    Phases of neither family have no residual limit.
    """
    name = F.upper("phase")
    limit = F.when(name.contains("P"), F.lit(p_limit or None)).when(name.contains("S"), F.lit(s_limit or None)).cast("double")
    keep = F.coalesce(F.abs("time_weight") > 1e-3, F.lit(False)) & (limit.isNull() | F.coalesce(F.abs("time_residual") <= limit, F.lit(True)))
    if km:
        keep &= F.coalesce(F.col("distance_deg") <= km / KM_PER_DEGREE, F.lit(True))
    return arrivals.where(keep)


def relocation_picks(arrivals: DataFrame, km: float | None = None, keep_unweighted: bool = False) -> DataFrame:
    """Arrivals to relocate with: those with a weight, or where unweighted ones stay, those within the distance."""
    if not keep_unweighted:
        return arrivals.where("time_weight is not null and time_weight <> 0")
    return arrivals if not km else arrivals.where(F.coalesce(F.col("distance_deg") <= km / KM_PER_DEGREE, F.lit(True)))


def dedup_arrivals(arrivals: DataFrame, corrected: bool = True) -> DataFrame:
    """One arrival per event, phase and station: that of the least residual by size; on ties the last.

    ``corrected=False`` compares signed residuals.
    """
    r = F.abs("time_residual") if corrected else F.col("time_residual")
    by = Window.partitionBy("event_id", "phase", "station").orderBy(r.asc_nulls_last(), F.desc("ord"))
    return arrivals.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def disposition(arrivals: DataFrame, next_begin_us: int, last_round: bool = False) -> DataFrame:
    """Whether each event is kept, pruned (reaches into the next window's overlap) or deleted (lies in it).

    First and last are over used arrivals; an event without any is kept.
    """
    t = F.when(used(), micros(F.col("pick_time")))
    ends = arrivals.groupBy("event_id").agg(F.min(t).alias("first_us"), F.max(t).alias("last_us"))
    if last_round:
        return ends.withColumn("disposition", F.lit("kept"))
    state = F.when(F.col("first_us") >= next_begin_us, "deleted").when(F.col("last_us") >= next_begin_us, "pruned").otherwise("kept")
    return ends.withColumn("disposition", state)


def event_key(prefix: str, time: Column) -> Column:
    """Readable event id: prefix, year, and the epoch milliseconds in base 36."""
    ms = F.expr("0") + F.floor(micros(time) / 1000)
    return F.concat(F.lit(prefix), F.year(time).cast("string"), F.lower(F.conv(ms.cast("bigint").cast("string"), 10, 36)))


def numbered(rows: DataFrame, parent: str, order: str, label: str) -> DataFrame:
    """Rows with ``readable_id``: the parent's id, a label and the place among its siblings from 0."""
    n = F.row_number().over(Window.partitionBy(parent).orderBy(order)) - 1
    return rows.withColumn("readable_id", F.concat(F.col(parent).cast("string"), F.lit(f"/{label}/"), n.cast("string")))


def dedup_picks(picks: DataFrame, keys: list[str], order: str = "pick_id") -> tuple[DataFrame, DataFrame]:
    """Picks without repeats of ``keys`` (the first stays), and ``old, new``: where each dropped pick's arrivals go."""
    first = F.first(order).over(Window.partitionBy(*keys).orderBy(order))
    marked = picks.withColumn("_first", first)
    return marked.where(F.col(order) == F.col("_first")).drop("_first"), marked.where(F.col(order) != F.col("_first")).select(F.col(order).alias("old"), F.col("_first").alias("new"))


def remap_arrivals(arrivals: DataFrame, moved: DataFrame) -> DataFrame:
    """Arrivals with dropped picks replaced by those that stay."""
    m = moved.withColumnRenamed("old", "pick_id")
    return arrivals.join(m, "pick_id", "left").withColumn("pick_id", F.coalesce("new", "pick_id")).drop("new")


def probability_comments(catalog_picks: DataFrame, cluster_picks: DataFrame) -> DataFrame:
    """Catalogue picks with a JSON comment of the cluster pick's probability.

    Joined on station, time and phase; ``network_differs`` tells where the
    networks don't agree. Of several cluster picks the best probability holds.
    """
    best = cluster_picks.groupBy("station", "phase_type", "phase_time").agg(F.max(F.struct("phase_score", "network")).alias("b"))
    j = catalog_picks.join(best, ["station", "phase_type", "phase_time"])
    text = F.format_string('{"probability": {"name": "probability", "value": %.2f}}', F.col("b.phase_score"))
    return j.withColumn("comment", text).withColumn("network_differs", F.col("network") != F.col("b.network")).drop("b")


def event_id_comments(arrivals: DataFrame, members: DataFrame, match_station: bool = True) -> DataFrame:
    """``event_id, cluster_id, comment``: the event ids of the cluster that holds the event's first used arrival found in any.

    First by the arrivals' order, then by cluster. ``match_station=False``
    compares time and phase alone.
    """
    keys = ["phase", "pick_us"] + (["station"] if match_station else [])
    m = members.select("cluster_id", F.col("phase_type").alias("phase"), micros(F.col("phase_time")).alias("pick_us"), "station").select("cluster_id", *keys).distinct()
    hit = arrivals.where(used()).withColumn("pick_us", micros(F.col("pick_time"))).join(m, keys)
    first = hit.groupBy("event_id").agg(F.min(F.struct("ord", "cluster_id")).alias("f")).select("event_id", F.col("f.cluster_id").alias("cluster_id"))
    ids = members.where("eventid is not null").groupBy("cluster_id").agg(F.array_sort(F.collect_set("eventid")).alias("ids"))
    return first.join(ids, "cluster_id").select("event_id", "cluster_id", F.to_json(F.struct(F.col("ids").alias("event_ids"))).alias("comment"))


def preloc_distance(preferred: DataFrame, prelocated: DataFrame, tool: str = "pyocto") -> DataFrame:
    """Distance in km of each preferred origin from the event's first origin whose method names ``tool``."""
    first = prelocated.where(F.col("method_id").contains(tool)).groupBy("event_id").agg(F.min(F.struct("ord", "latitude", "longitude")).alias("p"))
    j = preferred.join(first, "event_id")
    km = great_circle_km(F.col("p.latitude"), F.col("p.longitude"), F.col("latitude"), F.col("longitude"))
    return j.select("event_id", F.round(km, 6).alias("preloc_distance_km"))


def complete_channels(picks: DataFrame, hints: DataFrame) -> DataFrame:
    """Picks with missing network, location and channel filled from ordered hints, the first of each key.

    ``hints``: ord, network, station, location, channel (without its last
    letter, which is Z for P phases and N for S phases).
    """
    def first(keys, value):
        return hints.groupBy(*keys).agg(F.min(F.struct("ord", value)).alias("h")).select(*keys, F.col(f"h.{value}").alias("_h"))

    out = picks
    for keys, value in ((["station"], "network"), (["network", "station"], "location"), (["network", "station", "location"], "channel")):
        out = out.join(first(keys, value), keys, "left").withColumn(value, F.coalesce(value, "_h") if value in out.columns else F.col("_h")).drop("_h")
    last = F.when(F.col("phase").contains("P"), "Z").when(F.col("phase").contains("S"), "N")
    return out.withColumn("channel", F.when(F.length("channel") == 2, F.concat("channel", last)).otherwise(F.col("channel")))


def zone_cells(zones: DataFrame, degrees: float = CELL_DEGREES) -> DataFrame:
    """``cx, cy, ord, name, velocity_profile, border``: the cells of a grid that each zone holds or touches.

    Every point of a cell that isn't on the border lies strictly inside. A
    zone's cells are found along its edges, and between them by the crossings
    of the cells' middles, so they cost what the zone's extent in cells is.
    """

    def cells(frames):
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                ring = np.array([(p["lon"], p["lat"]) for p in r.points], np.float64) / degrees
                if len(ring) < 2 or not np.isfinite(ring).all():
                    continue
                low = np.floor(ring.min(axis=0)).astype(int) - 1
                wide, high = np.floor(ring.max(axis=0)).astype(int) + 2 - low
                touched, odd = np.zeros((wide, high), bool), np.zeros((wide, high), bool)
                middle = low[1] + np.arange(high) + 0.5
                for (x1, y1), (x2, y2) in itertools.pairwise(ring - low):
                    # Along the edge: in each column of cells the rows between the places where it comes and goes, and a little more.
                    x1, y1, x2, y2 = (x1, y1, x2, y2) if x1 <= x2 else (x2, y2, x1, y1)
                    for c in range(int(x1 - 1e-9), int(x2 + 1e-9) + 1):
                        u, v = (y1 + (y2 - y1) * (min(max(x, x1), x2) - x1) / (x2 - x1) if x2 > x1 else y for x, y in ((c, y1), (c + 1, y2)))
                        touched[c, int(min(u, v) - 1e-9) : int(max(u, v) + 1e-9) + 1] = True
                    m = middle - low[1]
                    rows = np.flatnonzero((y1 > m) != (y2 > m))
                    if len(rows):
                        x = x1 + (m[rows] - y1) * (x2 - x1) / (y2 - y1)
                        odd[:, rows] ^= (np.arange(wide)[:, None] + 0.5) < x[None, :]
                take = touched | odd
                cx, cy = np.nonzero(take)
                yield pd.DataFrame({"cx": (cx + low[0]).astype("int64"), "cy": (cy + low[1]).astype("int64"), "ord": int(r.ord), "name": r.name, "velocity_profile": r.velocity_profile, "border": touched[take]})

    return zones.select("ord", "name", "velocity_profile", "points").mapInPandas(cells, "cx long, cy long, ord int, name string, velocity_profile string, border boolean")


def first_zone(points: DataFrame, zones: DataFrame, key: str = "event_id", degrees: float = CELL_DEGREES) -> DataFrame:
    """``key, zone, velocity_profile``: the first zone (by ``ord``) that strictly holds the point.

    Points meet zones by the cell that they are in; only in cells on a zone's
    border is the ring itself tried.
    """
    cells = materialize(zone_cells(zones, degrees), "zone-cells")  # written, so that Spark knows its size
    at = points.select(key, "longitude", "latitude", F.floor(F.col("longitude") / degrees).alias("cx"), F.floor(F.col("latitude") / degrees).alias("cy"))
    met = at.join(cells, ["cx", "cy"])
    rings = zones.select(F.col("ord").alias("_ord"), "points")
    close = met.where("border").join(rings, F.col("ord") == F.col("_ord"))
    close = close.where(inside_polygon(F.col("longitude"), F.col("latitude"), F.col("points"))).select(key, "ord", "name", "velocity_profile")
    inside = met.where("not border").select(key, "ord", "name", "velocity_profile").union(close)
    best = inside.groupBy(key).agg(F.min(F.struct("ord", "name", "velocity_profile")).alias("z"))
    return best.select(key, F.col("z.name").alias("zone"), F.col("z.velocity_profile").alias("velocity_profile"))


def zones_with_profiles(zones: DataFrame, profiles: DataFrame) -> DataFrame:
    """Zones with the columns of their velocity profile (``velocity_profile``); none at all if a zone names a profile that is missing."""
    missing = zones.join(profiles, "velocity_profile", "left_anti").agg(F.count("*").alias("_missing"))
    return zones.join(profiles, "velocity_profile").crossJoin(missing).where("_missing = 0").drop("_missing")  # one row of a count


def merge_catalogs(info: DataFrame, children: DataFrame) -> DataFrame:
    """Children (origins, magnitudes, picks) of all events that an event's space-separated list names, under that event."""
    parts = info.select(F.col("event_id").alias("merged_id"), F.explode(F.array_distinct(F.split(F.coalesce("agencies_list", F.lit("")), " "))).alias("event_id")).where("event_id <> ''")
    return parts.join(children.withColumn("event_id", F.col("event_id").cast("string")), "event_id")


def export_picks(arrivals: DataFrame, agency: str, probability: float = 1.0) -> DataFrame:
    """Weighted arrivals as picks of the second layout."""
    rows = arrivals.where("time_weight is not null and time_weight <> 0")
    return rows.select(F.col("station").alias("seedid"), F.col("phase").alias("phasename"), F.col("pick_time").alias("time"), F.lit(probability).alias("probability"), F.col("event_id").cast("string").alias("eventid"), F.lit(agency).alias("agency"))


def pick_report(arrivals: DataFrame) -> DataFrame:
    """Probability of each pick whose weight isn't 0, read from its JSON ``comment``; malformed comments are skipped."""
    value = F.get_json_object("comment", "$.probability.value").cast("double")
    rows = arrivals.where("time_weight is null or time_weight <> 0")
    return rows.select("event_id", "ord", "station", "phase", value.alias("probability")).where("probability is not null")


def event_table(origins: DataFrame) -> DataFrame:
    """The event table: a row per origin, the preferred one of an event first, under the twelve columns of the listing.

    ``tag`` is FAKE for events that don't exist and marks origins that aren't
    preferred; gaps that are missing or 0 show as a dash.
    """
    gap = lambda c: F.when(F.coalesce(F.col(c), F.lit(0.0)) != 0, F.format_string("%.1f", c)).otherwise("-")
    tag = F.when(~F.col("preferred"), " |__").when(F.col("event_type") == "not existing", "FAKE").otherwise("")
    return origins.select(
        "event_id", "preferred", tag.alias("tag"), F.col("origin_time").alias("time"), F.format_string("%.3f", "latitude").alias("latitude"), F.format_string("%.3f", "longitude").alias("longitude"), F.format_string("%.1f", F.col("depth_km") * 1000).alias("depth"),
        F.col("standard_error").alias("rms"), F.col("used_station_count").alias("sta_count"), F.col("used_phase_count").alias("phase_count"), gap("azimuthal_gap").alias("gap1"), gap("secondary_azimuthal_gap").alias("gap2"),
        last_segment(F.col("earth_model_id")).alias("model"), last_segment(F.col("method_id")).alias("locator"),
    )


def event_lines(table: DataFrame) -> DataFrame:
    """Rows of :func:`event_table` as text, separated by a comma and a space."""
    cols = [c for c in table.columns if c not in ("event_id", "preferred")]
    return table.select("event_id", "preferred", F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in cols]).alias("line"))


def event_ids_report(events: DataFrame) -> DataFrame:
    """Time, id, and the number and list of the event ids that an event's comments (array of JSON texts) name, in their order.

    Comments that are no JSON or name none count for nothing.
    """
    named = F.flatten(F.transform("comments", lambda x: F.coalesce(F.from_json(F.get_json_object(x, "$.event_ids"), "array<string>"), F.array().cast("array<string>"))))
    ids = F.coalesce(named, F.array().cast("array<string>"))
    return events.select(F.col("origin_time").alias("time"), "event_id", F.size(ids).alias("nb_agencies"), F.concat_ws(" ", ids).alias("agencies_list"))


def last_segment(path: Column) -> Column:
    """What follows the last slash."""
    return F.element_at(F.split(path, "/"), -1)


def quoted(text: Column) -> Column:
    """Percent-encoded text, a space as %20."""
    return F.replace(F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def unquoted(text: Column) -> Column:
    """The text behind percent codes; a plus stays one."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def with_picks(arrivals: DataFrame, picks: DataFrame) -> DataFrame:
    """Arrivals with the first pick (by ``ord``, then the other columns) of their pick_id, null where there is none."""
    cols = ["ord", *[c for c in picks.columns if c not in ("pick_id", "ord")]]
    first = picks.groupBy("pick_id").agg(F.min(F.struct(*cols)).alias("pick"))
    return arrivals.join(first, "pick_id", "left")


def reach_km(cloud: DataFrame) -> DataFrame:
    """Twice the greatest great-circle distance between the barycentre of a cloud's best samples and its extent's corners, in km."""
    s = scatter_summary(cloud)
    corners = [(f"{a}_latitude", f"{b}_longitude") for a in ("min", "max") for b in ("min", "max")]
    far = F.greatest(*[great_circle_km(F.col("best_latitude"), F.col("best_longitude"), F.col(x), F.col(y)) for x, y in corners])
    return s.withColumn("region_km", 2 * far)


def removal_counts(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows of each key a step has left out."""
    x = before.groupBy(*keys).agg(F.count("*").alias("n_before"))
    y = after.groupBy(*keys).agg(F.count("*").alias("n_after"))
    out = x.join(y, keys, "left").withColumn("n_after", F.coalesce("n_after", F.lit(0)))
    return out.withColumn("removed", F.col("n_before") - F.col("n_after"))


def scatter_summary(cloud: DataFrame) -> DataFrame:
    """Mean position of the most probable samples (all rows of the greatest h2) and the extent of the cloud."""
    at = F.struct("latitude", "longitude", "depth")
    # One scan: sums over the rows of each h2 are few where it is a rank, and otherwise combine before the shuffle.
    per = cloud.groupBy("h2").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("latitude", "longitude", "depth")], *[f(c).alias(f"{n}_{c}") for c in ("latitude", "longitude") for n, f in (("min", F.min), ("max", F.max))])
    one = per.agg(F.max_by(F.struct("n", at.alias("at")), "h2").alias("b"), *[f(f"{n}_{c}").alias(f"{n}_{c}") for c in ("latitude", "longitude") for n, f in (("min", F.min), ("max", F.max))])
    return one.select(*[(F.col(f"b.at.{c}") / F.col("b.n")).alias(f"best_{c}") for c in ("latitude", "longitude", "depth")], F.col("b.n").alias("n_best"), *[f"{n}_{c}" for c in ("latitude", "longitude") for n in ("min", "max")])


def sound_origins(origins: DataFrame, errors: list[str], status: str | None = None) -> DataFrame:
    """Origins whose errors are numbers and whose locator status doesn't say that it gave up."""
    for c in errors:
        origins = origins.where(F.col(c).isNotNull() & ~F.isnan(c))
    return origins if status is None else origins.where(F.coalesce(~F.upper(status).rlike("ABORTED|IGNORED|REJECTED"), F.lit(True)))


def with_prelocation(origins: DataFrame, preloc: DataFrame, model: str) -> DataFrame:
    """Origins plus, as origins of their own, the first locations that association gave (depth in m)."""
    extra = preloc.select("event_id", "origin_time", "latitude", "longitude", (F.col("preloc_depth_m") / 1000).alias("depth_km"), F.lit("tremor/associator").alias("method_id"), F.lit(model).alias("earth_model_id"))
    return origins.unionByName(extra, allowMissingColumns=True)


def stamped(origins: DataFrame, **defaults: str) -> DataFrame:
    """Origins with agency, author, mode, method and model where these are missing."""
    return origins.withColumns({k: F.coalesce(origins[k] if k in origins.columns else F.lit(None).cast("string"), F.lit(v)) for k, v in defaults.items()})


def matched_events(first: DataFrame, second: DataFrame, seconds: float, km: float) -> DataFrame:
    """``id, other, seconds, km``: events of two catalogues that lie within so many seconds and km of one another.

    ``first`` has ``id, us, latitude, longitude`` and ``second`` ``other`` and
    the same. They join on bins of time as wide as the limit.
    """
    width = max(1, round(seconds * 1e6))
    a = first.withColumn("bin", F.explode(F.expr(f"array(us div {width} - 1, us div {width}, us div {width} + 1)"))).alias("a")
    b = second.withColumn("bin", F.expr(f"us div {width}")).alias("b")
    c = F.col
    far = great_circle_km(c("a.latitude"), c("a.longitude"), c("b.latitude"), c("b.longitude"))
    met = a.join(b, "bin").select("id", "other", (F.abs(c("a.us") - c("b.us")) / 1e6).alias("seconds"), far.alias("km"))
    return met.where((c("seconds") <= seconds) & (c("km") <= km))
