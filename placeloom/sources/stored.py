"""Stored map and register files as a Spark data source: one partition a unit, and only the files of the units that a query asks for.

``spark.read.format("placeloom_stored").option("kind", "map").load(folder)`` reads a folder of JSON files named by unit (underscores for spaces).
The option ``units`` (a JSON list) chooses files before any is opened; ``type`` and ``box`` (a JSON list of south, west, north, east) leave out map
elements before they become rows. These are options, not pushed conditions: Spark 4.1 keeps a Python reader with the conditions of the first
query over a frame, and would leave out the same rows in a later one without them. ``read_stored`` sets them. Files are opened by workers through ``pyarrow.fs``. A file that cannot be parsed is an error of the unit that has it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Columns of each kind of file.
KINDS = {
    "map": "unit string, pos long, type string, id long, lat double, lon double, tags map<string,string>",
    "register": "unit string, pos long, FHRSID long, BusinessName string, BusinessTypeID long, AddressLine1 string, AddressLine2 string, AddressLine3 string, PostCode string, Phone string, latitude string, longitude string",
}


def read_stored(spark: SparkSession, path: str, kind: str = "map", units: list[str] | None = None, type_: str | None = None, box: list[float] | None = None) -> DataFrame:
    """Rows of the files of ``units`` (all if None); of maps those of a type and within a box, edges included."""
    spark.dataSource.register(StoredSource)
    asked = {"units": units, "type": type_, "box": box}
    options = {k: v if k == "type" else json.dumps(v) for k, v in asked.items() if v is not None}
    return spark.read.format("placeloom_stored").options(kind=kind, **options).load(path)


class StoredSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "placeloom_stored"

    def schema(self) -> str:
        return KINDS[self.options.get("kind", "map")]

    def reader(self, schema: StructType) -> StoredReader:
        return StoredReader(self.options, schema.names)


class UnitFile(InputPartition):
    def __init__(self, unit: str, path: str):
        super().__init__(path)
        self.unit, self.path = unit, path


class StoredReader(DataSourceReader):
    def __init__(self, options: dict[str, str], names: list[str]):
        self.path, self.kind, self.names = options["path"], options.get("kind", "map"), names
        self.units = set(json.loads(options["units"])) if "units" in options else None
        self.type, self.box = options.get("type"), json.loads(options.get("box", "null"))

    def _opened(self) -> tuple[pyarrow.fs.FileSystem, str]:
        return pyarrow.fs.FileSystem.from_uri(self.path) if ":/" in self.path else (pyarrow.fs.LocalFileSystem(), self.path)

    def partitions(self) -> list[UnitFile]:
        fs, path = self._opened()
        files = fs.get_file_info(pyarrow.fs.FileSelector(path))
        named = sorted((f.base_name[:-5].replace("_", " "), f.path) for f in files if f.is_file and f.extension == "json")
        return [UnitFile(u, p) for u, p in named if self.units is None or u in self.units]

    def _within(self, lat: float | None, lon: float | None) -> bool:
        if self.box is None:
            return True
        south, west, north, east = self.box
        return lat is not None and lon is not None and south <= lat <= north and west <= lon <= east

    def read(self, partition: UnitFile) -> Iterator[tuple]:
        if partition is None:  # no file was asked for
            return
        fs, _ = self._opened()
        with fs.open_input_stream(partition.path) as source:
            stored = json.loads(source.read())
        if self.kind == "map":
            for i, e in enumerate(stored):
                middle = e.get("center") or {}
                lat, lon = e.get("lat") or middle.get("lat"), e.get("lon") or middle.get("lon")
                if (self.type is None or e["type"] == self.type) and self._within(lat, lon):
                    place = [None if v is None else float(v) for v in (lat, lon)]
                    yield partition.unit, i, e["type"], e["id"], *place, {k: str(v) for k, v in (e.get("tags") or {}).items()}
            return
        plain = self.names[2:-2]
        for i, e in enumerate(stored["establishments"] if isinstance(stored, dict) else stored):
            at = e.get("geocode") or {}
            yield partition.unit, i, *[e.get(c) for c in plain], at.get("latitude"), at.get("longitude")
