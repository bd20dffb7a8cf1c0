"""Tables that are made of loads, each of which can be replaced as a whole.

A load's rows are in ``load=<name>/version=<n>``. A version counts once its marker is there, so a reader sees a load before or after it
is replaced and never in between, and a job that dies leaves the old one in place. A marker also says of which days (or
other parts) the load holds rows now, and of which its version before did: a run that follows a load needs both. One writer per load at a time.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.schemas import no_rows


def hadoop(spark: SparkSession, path: str):
    """File system and path object, as the job's own readers and writers see them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = hadoop(spark, path)
    fs.delete(p, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    fs, p = hadoop(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


@dataclass(frozen=True)
class LoadStore:
    """``part`` is the column that splits a load, the days of readings for instance."""

    spark: SparkSession
    path: str
    schema: T.StructType
    part: str = "day"

    def versions(self) -> dict[str, int]:
        """Newest version of each load; one listing of the markers."""
        found: dict[str, int] = {}
        for name in names_in(self.spark, f"{self.path}/_loads"):
            load, _, n = name.rpartition("@")
            if load and n.isdigit():
                found[load] = max(found.get(load, 0), int(n))
        return found

    def folders(self, loads: dict[str, int]) -> list[str]:
        """Folders of versions of loads; a load without rows has none."""
        fs, p = hadoop(self.spark, f"{self.path}/load=*/version=*")
        found = {f.getPath().getParent().getName() + "/" + f.getPath().getName() for f in fs.globStatus(p) or []}
        wanted = (f"load={load}/version={n}" for load, n in loads.items())
        return [f"{self.path}/{f}" for f in wanted if f in found]

    def read(self, loads: dict[str, int] | None = None, version: bool = False) -> DataFrame:
        """Rows of all loads, or of given versions of some; with their ``version`` if asked for."""
        return self._rows(self.folders(self.versions() if loads is None else loads), version)

    def any_version(self, loads: list[str]) -> DataFrame:
        """Rows of every version of some loads that is on disk, such of dead jobs included."""
        fs, p = hadoop(self.spark, f"{self.path}/load=*/version=*")
        found = [f.getPath().toString() for f in fs.globStatus(p) or []]
        wanted = {f"load={load}" for load in loads}
        return self._rows([f for f in found if f.rsplit("/", 2)[1] in wanted])

    def _rows(self, folders: list[str], version: bool = False) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("version", T.IntegerType())]) if version else self.schema
        if not folders:
            return no_rows(self.spark, schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders).select(*schema.names)

    def next_version(self) -> int:
        return max(self.versions().values(), default=0) + 1

    def write(self, rows: DataFrame, loads: dict[str, int], order: list[str]) -> None:
        """Write a version of each load; rows say their ``load`` and ``version``. Nothing counts before :meth:`commit`."""
        for load, n in loads.items():
            remove(self.spark, f"{self.path}/load={load}/version={n}")
        placed = rows.sortWithinPartitions("load", "version", self.part, *order)
        placed.write.mode("append").partitionBy("load", "version", self.part).parquet(self.path)

    def commit(self, loads: dict[str, int]) -> None:
        """Make a written version of each load its newest one. The one before stays for readers that have begun; older ones go."""
        for load, version in loads.items():
            before = [n for n in self._numbers(load) if n < version]
            last = self.entry(load, before[-1])["parts"] if before else []
            parts = sorted(p.partition("=")[2] for p in names_in(self.spark, f"{self.path}/load={load}/version={version}") if p.startswith(f"{self.part}="))
            self._mark(load, version, {"parts": parts, "former": last})
            for n in before[:-1]:
                remove(self.spark, f"{self.path}/_loads/{load}@{n}")
                remove(self.spark, f"{self.path}/load={load}/version={n}")

    def entry(self, load: str, version: int) -> dict[str, list[str]]:
        """``parts`` of a version of a load, and ``former`` ones of the version before."""
        fs, p = hadoop(self.spark, f"{self.path}/_loads/{load}@{version}")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def parts_of_date(self, date: str) -> set[str]:
        """Parts that the loads of a date hold or held. A load belongs to the date that its name ends with or, without one (a
        streamed load), to its newest part."""
        found: set[str] = set()
        for load, n in self.versions().items():
            named = re.search(r"-(\d{4}-\d\d-\d\d)$", load)
            if named and named[1] != date:
                continue
            entry = self.entry(load, n)
            parts = {*entry["parts"], *entry["former"]}
            if load.endswith(f"-{date}") or (not named and max(parts, default="") == date):
                found |= parts
        return found

    def drop_parts(self, before: str) -> int:
        """Remove the parts before a value from all loads; how many there were."""
        gone = 0
        for folder in self.folders(self.versions()):
            for name in names_in(self.spark, folder):
                if name.startswith(f"{self.part}=") and name.partition("=")[2] < before:
                    remove(self.spark, f"{folder}/{name}")
                    gone += 1
        return gone

    def _numbers(self, load: str) -> list[int]:
        found = (name.rpartition("@") for name in names_in(self.spark, f"{self.path}/_loads"))
        return sorted(int(n) for name, _, n in found if name == load and n.isdigit())

    def _mark(self, load: str, version: int, content: dict) -> None:
        fs, p = hadoop(self.spark, f"{self.path}/_loads/{load}@{version}")
        stream = fs.create(p, True)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
