"""Event catalogues as QuakeML: reading into flat tables, writing parts in parallel.

One file is parsed by one task (a catalogue is written in parts of bounded
size); a part holds up to ``per_file`` events in order of time.
"""

from __future__ import annotations

import os
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NS = "http://quakeml.org/xmlns/bed/1.2"
EVENTS = "event_id string, event_type string, preferred_origin_id string, origin_id string, origin_time timestamp, latitude double, longitude double, depth_m double, method_id string, evaluation_mode string, comments array<string>"
ARRIVALS = "event_id string, origin_id string, arrival_id string, ord int, pick_id string, phase string, time_weight double, time_residual double, distance_deg double, network string, station string, location string, channel string, pick_time timestamp, pick_comment string"


def _strip(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _text(node, *path) -> str | None:
    for name in path:
        node = next((c for c in node if _strip(c.tag) == name), None) if node is not None else None
    return None if node is None or node.text is None else node.text.strip()


def _all(node, name):
    return [c for c in node if _strip(c.tag) == name]


def _number(text: str | None) -> float | None:
    return None if text in (None, "") else float(text)


def _time(text: str | None):
    return None if not text else pd.Timestamp(text.replace("Z", "+00:00")).tz_convert("UTC") if text.endswith("Z") or "+" in text else pd.Timestamp(text, tz="UTC")


def _events(content: bytes):
    for top in ET.fromstring(content).iter():
        if _strip(top.tag) == "event":
            yield top


def event_rows(content: bytes) -> list[tuple]:
    """One row per origin of each event (one without origin columns for an event without any)."""
    out = []
    for e in _events(content):
        notes = [t for c in _all(e, "comment") if (t := _text(c, "text"))]
        head = (e.get("publicID"), _text(e, "type"), _text(e, "preferredOriginID"))
        for o in _all(e, "origin") or [None]:
            if o is None:
                out.append((*head, None, None, None, None, None, None, None, notes))
            else:
                out.append((*head, o.get("publicID"), _time(_text(o, "time", "value")), _number(_text(o, "latitude", "value")), _number(_text(o, "longitude", "value")), _number(_text(o, "depth", "value")), _text(o, "methodID"), _text(o, "evaluationMode"), notes))
    return out


def arrival_rows(content: bytes) -> list[tuple]:
    """One row per arrival with the pick that it names (the first of that id)."""
    out = []
    for e in _events(content):
        by_id: dict = {}
        for p in _all(e, "pick"):
            by_id.setdefault(p.get("publicID"), p)
        for o in _all(e, "origin"):
            for n, a in enumerate(_all(o, "arrival")):
                p = by_id.get(_text(a, "pickID"))
                w = next(iter(_all(p, "waveformID")), None) if p is not None else None
                ids = [w.get(k) if w is not None else None for k in ("networkCode", "stationCode", "locationCode", "channelCode")]
                note = next((t for c in (_all(p, "comment") if p is not None else []) if (t := _text(c, "text"))), None)
                out.append((e.get("publicID"), o.get("publicID"), a.get("publicID"), n, _text(a, "pickID"), _text(a, "phase"), _number(_text(a, "timeWeight")), _number(_text(a, "timeResidual")), _number(_text(a, "distance")), *ids, _time(_text(p, "time", "value")) if p is not None else None, note))
    return out


def _read(spark: SparkSession, path, parse, schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for content in f["content"]:
                yield pd.DataFrame(parse(bytes(content)), columns=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


def read_origins(spark: SparkSession, path) -> DataFrame:
    return _read(spark, path, event_rows, EVENTS)


def read_arrivals(spark: SparkSession, path) -> DataFrame:
    return _read(spark, path, arrival_rows, ARRIVALS)


def event_xml(row: dict) -> str:
    """One event with its origin, picks and arrivals as a QuakeML element."""
    e = ET.Element("event", publicID=str(row["event_id"]))
    ET.SubElement(e, "type").text = row.get("event_type") or "earthquake"
    ET.SubElement(e, "preferredOriginID").text = str(row["origin_id"])
    for note in row.get("comments") or []:
        ET.SubElement(ET.SubElement(e, "comment"), "text").text = note
    o = ET.SubElement(e, "origin", publicID=str(row["origin_id"]))
    for tag, key in (("time", "origin_time"), ("latitude", "latitude"), ("longitude", "longitude"), ("depth", "depth_m")):
        v = row[key]
        ET.SubElement(ET.SubElement(o, tag), "value").text = v.strftime("%Y-%m-%dT%H:%M:%S.%fZ") if tag == "time" else repr(float(v))
    if row.get("method_id"):
        ET.SubElement(o, "methodID").text = row["method_id"]
    for k, a in enumerate(row.get("arrivals") if row.get("arrivals") is not None else []):
        pick = f"{row['event_id']}/pick/{k}"
        p = ET.SubElement(e, "pick", publicID=pick)
        ET.SubElement(ET.SubElement(p, "time"), "value").text = pd.Timestamp(a["pick_time"]).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
        codes = {n: a.get(c) for n, c in (("networkCode", "network"), ("stationCode", "station"), ("locationCode", "location"), ("channelCode", "channel"))}
        ET.SubElement(p, "waveformID", {n: v for n, v in codes.items() if v is not None})
        ET.SubElement(p, "phaseHint").text = a["phase"]
        x = ET.SubElement(o, "arrival", publicID=f"{row['origin_id']}/arrival/{k}")
        for tag, key in (("pickID", None), ("phase", "phase"), ("timeWeight", "time_weight"), ("timeResidual", "time_residual"), ("distance", "distance_deg")):
            v = pick if key is None else a.get(key)
            if v is not None:
                ET.SubElement(x, tag).text = str(v)
    return ET.tostring(e, encoding="unicode")


def document(events: list[str]) -> str:
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<q:quakeml xmlns:q="http://quakeml.org/xmlns/quakeml/1.2" xmlns="{NS}"><eventParameters publicID="smi:local/catalog">{"".join(events)}</eventParameters></q:quakeml>\n'


def write_catalog(events: DataFrame, path: str, per_file: int = 100, partitions: int = 8) -> None:
    """Events (a row each, with an ``arrivals`` array) as QuakeML parts of ``per_file`` events in order of time.

    Ranges of time are parts of the job, so the parts are written in parallel
    through Spark's text writer; existing output is an error.
    """
    xml = F.udf(lambda r: event_xml(r.asDict(recursive=True)))  # one call per event, as XML has no column function
    parts = events.repartitionByRange(partitions, "origin_time").sortWithinPartitions("origin_time")
    lines = parts.select(F.spark_partition_id().alias("p"), "origin_time", xml(F.struct(*events.columns)).alias("x"))
    numbered = lines.withColumn("f", F.expr(f"(row_number() over (partition by p order by origin_time) - 1) div {per_file}"))
    docs = numbered.groupBy("p", "f").agg(F.array_sort(F.collect_list(F.struct("origin_time", "x"))).alias("e"))
    head, tail = document(["\x00"]).split("\x00")
    docs.select(F.concat(F.lit(head), F.array_join(F.transform("e", lambda v: v["x"]), ""), F.lit(tail)).alias("value")).write.mode("errorifexists").option("lineSep", "\n").option("maxRecordsPerFile", 1).text(path)


STATIONS = "network string, station string, channel string, start_date date, end_date date, latitude double, longitude double, elevation double"


def station_rows(content: bytes) -> list[tuple]:
    """One row per channel epoch of a station inventory (one per station without channels)."""
    out = []
    day = lambda node, k: pd.Timestamp(node.get(k)).date() if node.get(k) else None
    for net in ET.fromstring(content).iter():
        if _strip(net.tag) != "Network":
            continue
        for sta in _all(net, "Station"):
            for node in _all(sta, "Channel") or [sta]:
                place = [_number(_text(node, k)) for k in ("Latitude", "Longitude", "Elevation")]
                out.append((net.get("code"), sta.get("code"), node.get("code") if node is not sta else None, day(node, "startDate"), day(node, "endDate"), *place))
    return out


def read_inventory(spark: SparkSession, path) -> DataFrame:
    """Channel epochs of one or several station inventories (XML)."""
    return _read(spark, path, station_rows, STATIONS)


def write_events(events: DataFrame, path: str, form: str = "quakeml", per_file: int = 100) -> None:
    """Events in a configured format: quakeml, json or parquet; existing output is an error."""
    if form == "quakeml":
        write_catalog(events, path, per_file)
    elif form in ("json", "parquet"):
        events.write.mode("errorifexists").option("maxRecordsPerFile", per_file).format(form).save(path)
    else:
        raise ValueError(f"unknown format: {form}")


def render(template: str, tags: dict[str, str]) -> str:
    """A locator's control text with its tags replaced."""
    for k, v in tags.items():
        template = template.replace(k, v)
    return template


def read_config(path: str) -> dict:
    """YAML settings with ``!join`` lists put together into one text."""
    import yaml

    class Loader(yaml.SafeLoader):
        pass

    Loader.add_constructor("!join", lambda loader, node: "".join(str(x) for x in loader.construct_sequence(node)))
    with open(os.fspath(path)) as f:
        return yaml.load(f, Loader)  # noqa: S506 (a SafeLoader)
