"""What seismological web services give, as data sources of Spark: stations, and events by their id.

Both read files in the services' own formats from a folder that all executors
see (answers that were stored, one file each), a partition for each file.
Filters on the columns that name a file's content leave files unread.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlparse

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from tremor.sources import catalog_xml

STATION = "network string, station string, latitude double, longitude double, elevation double, site string, start_time string, end_time string"
_NAMES = {"network": "network", "station": "station", "latitude": "latitude", "longitude": "longitude", "elevation": "elevation", "sitename": "site", "starttime": "start_time", "endtime": "end_time"}


def local_path(path: str) -> str:
    """A path of the local or a mounted file system, with or without ``file:``."""
    u = urlparse(path)
    if u.scheme not in ("", "file"):
        raise ValueError(f"{path}: mount the folder, or read it with Spark's own readers")
    return unquote(u.path) if u.scheme else path


def files_in(path: str, ending: str) -> list[str]:
    """A file itself, or the files of a folder with an ending, in order."""
    path = local_path(path)
    return [path] if os.path.isfile(path) else sorted(os.path.join(path, f) for f in os.listdir(path) if f.endswith(ending))


def _wanted(filters: list[Filter], column: str) -> tuple[set[str] | None, list[Filter]]:
    """The values of a column that filters leave (None: all), and the filters that say something else."""
    values, rest = None, []
    for f in filters:
        if isinstance(f, EqualTo | In) and f.attribute == (column,):
            these = {f.value} if isinstance(f, EqualTo) else set(f.value)
            values = these if values is None else values & these
        else:
            rest.append(f)
    return values, rest


class FilePartition(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


def station_lines(lines: Iterator[str]) -> Iterator[tuple]:
    """Rows of station text: fields between bars, the header behind a #, values with spaces around them."""
    head: list[str] | None = None
    for line in lines:
        fields = [x.strip() for x in line.rstrip("\n").lstrip("#").split("|")]
        if head is None:
            head = [x.lower().replace(" ", "") for x in fields]
            continue
        if not line.strip() or line.startswith("#"):
            continue
        row = {_NAMES[k]: v for k, v in zip(head, fields, strict=False) if k in _NAMES and v}
        number = lambda k: float(row[k]) if k in row else None  # noqa: B023, E731
        yield (row.get("network"), row.get("station"), number("latitude"), number("longitude"), number("elevation"), row.get("site"), row.get("start_time"), row.get("end_time"))


class StationReader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.networks, self.stations = path, None, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        self.networks, filters = _wanted(filters, "network")
        self.stations, filters = _wanted(filters, "station")
        yield from filters

    def partitions(self) -> list[FilePartition]:
        return [FilePartition(p) for p in files_in(self.path, ".txt")]

    def read(self, partition: FilePartition) -> Iterator[tuple]:
        with open(partition.path, encoding="utf-8") as f:
            for row in station_lines(f):
                if (self.networks is None or row[0] in self.networks) and (self.stations is None or row[1] in self.stations):
                    yield row


class StationSource(DataSource):
    """``spark.read.format("tremor_stations").load(folder)``: station text of ``*.txt`` files."""

    @classmethod
    def name(cls) -> str:
        return "tremor_stations"

    def schema(self) -> str:
        return STATION

    def reader(self, schema) -> StationReader:
        return StationReader(self.options["path"])


def event_file(event_id: str) -> str:
    """The name of an event's file: its id, quoted."""
    return quote(event_id, safe="") + ".xml"


class EventReader(DataSourceReader):
    def __init__(self, path: str, arrivals: bool):
        self.path, self.arrivals, self.ids = path, arrivals, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        self.ids, rest = _wanted(filters, "event_id")
        yield from rest

    def partitions(self) -> list[FilePartition]:
        if self.ids is None:
            return [FilePartition(p) for p in files_in(self.path, ".xml")]
        folder = local_path(self.path)
        found = [os.path.join(folder, event_file(i)) for i in sorted(i for i in self.ids if i is not None)]
        return [FilePartition(p) for p in found if os.path.exists(p)]  # as from the service: an unknown id has no event

    def read(self, partition: FilePartition) -> Iterator[tuple]:
        with open(partition.path, "rb") as f:
            rows = (catalog_xml.arrival_rows if self.arrivals else catalog_xml.event_rows)(f.read())
        for row in rows:
            if self.ids is None or row[0] in self.ids:
                yield tuple(v.to_pydatetime() if hasattr(v, "to_pydatetime") else v for v in row)


class EventSource(DataSource):
    """``spark.read.format("tremor_events").load(folder)``: QuakeML, a file for each event, named :func:`event_file`.

    Option ``content`` is ``origins`` (default) or ``arrivals``. A filter on
    ``event_id`` opens the files of those events only.
    """

    @classmethod
    def name(cls) -> str:
        return "tremor_events"

    def _arrivals(self) -> bool:
        return self.options.get("content", "origins") == "arrivals"

    def schema(self) -> str:
        return catalog_xml.ARRIVALS if self._arrivals() else catalog_xml.EVENTS

    def reader(self, schema) -> EventReader:
        return EventReader(self.options["path"], self._arrivals())


def register(spark: SparkSession) -> None:
    """Makes both formats known to a session, with filters handed to them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (StationSource, EventSource):
        spark.dataSource.register(source)
