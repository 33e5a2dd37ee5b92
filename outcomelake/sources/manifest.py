"""What a lake holds: an append-only table of files for every location, and the switch between versions.

A write goes to a folder of its own, ``_commit=<id>/year=/month=``.  Nobody reads it until one
append to the location's manifest names its files and, at once, the months of earlier commits
that it replaces.  That append is a single file, so a reader, and a run that stops half way,
sees the old files or the new ones.  A row per file tells its month, size, rows, range of times,
columns and landing number; inventories and marks read these rows and no data.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelake.session import freed_shuffles
from outcomelake.sources import storage

COMMIT = "_commit"
UNIT = [COMMIT, "year", "month"]
PARTITION = ["year", "month"]
_ROWS = (
    "op string, _commit string, seq long, landed long, year int, month int, path string, bytes long, modified timestamp, rows long, "
    "min_timestamp long, max_timestamp long, compacted boolean, schema_json string"
)


@dataclass(frozen=True)
class Commit:
    """A write that has not been switched to yet."""

    id: str
    seq: int
    folder: str


def columns_of(schema: T.StructType) -> T.StructType:
    """The stored columns, without those that folders spell out."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema if f.name not in UNIT])


def fingerprint(schemas: list[T.StructType]) -> str:
    """One hash of the columns and types of a month's files, in any order of columns and files."""
    texts = {"\n".join(sorted(f"{f.name} {f.dataType.simpleString()}" for f in columns_of(s))) for s in schemas}
    return hashlib.sha256("\n\n".join(sorted(texts)).encode()).hexdigest()


class Manifest:
    """The manifest of one location; one writer at a time, any number of readers."""

    def __init__(self, spark: SparkSession, root: str, location: str) -> None:
        self.spark, self.location = spark, location.rstrip("/")
        inside = self.location.removeprefix(root.rstrip("/")).strip("/")
        if not self.location.startswith(root.rstrip("/") + "/"):
            raise ValueError(f"{location} lies outside the lake {root}")
        self.table = f"{root.rstrip('/')}/_state/files/{inside}"

    # -- reading -------------------------------------------------------------

    def rows(self) -> DataFrame:
        if not self._known():
            return self.spark.createDataFrame([], _ROWS)
        return self.spark.read.schema(_ROWS).json(f"{self.table}/*.json")

    def _known(self) -> bool:
        return any(name.endswith(".json") for name in storage.children(self.spark, self.table))

    def files(self) -> DataFrame:
        """The live files; a month of a commit is replaced as a whole, never in part."""
        rows = self.rows()
        gone = rows.where("op = 'drop'").select(*UNIT).distinct()
        return rows.where("op = 'add'").join(gone, UNIT, "left_anti").drop("op")

    def units(self) -> DataFrame:
        """Live months of commits, a few per month between two compactions: what a scan names."""
        alike = [F.max(c).alias(c) for c in ("schema_json", "landed", "compacted")]  # one value per unit
        if not self._known():
            return self.rows().select(*UNIT, "schema_json", "landed", "compacted", "rows")
        units = self.rows().groupBy(*UNIT).agg(F.bool_or(F.col("op") == "drop").alias("_gone"), F.sum("rows").alias("rows"), *alike)
        return units.where("NOT _gone").drop("_gone")

    # -- writing -------------------------------------------------------------

    def begin(self) -> Commit:
        """A folder to write to; ids sort by landing number, which is above that of every folder there is."""
        names = [n.removeprefix(f"{COMMIT}=") for n in storage.children(self.spark, self.location) if n.startswith(f"{COMMIT}=")]
        seq = 1 + max((int(n.split("-")[0]) for n in names), default=0)
        name = f"{seq:010d}-{uuid.uuid4().hex[:12]}"
        return Commit(name, seq, f"{self.location}/{COMMIT}={name}")

    def facts(self, commit: Commit, schema: T.StructType, compacted: bool = False, landed: DataFrame | None = None) -> DataFrame:
        """A row per file of the commit; of its data the ``timestamp`` column is read, once.

        ``landed`` (year, month, landed) carries over the landing numbers of what was merged.
        """
        kinds = "timestamp long, year int, month int"
        rows = self.spark.read.schema(kinds).parquet(commit.folder)
        about = {"path": "file_path", "bytes": "file_size", "modified": "file_modification_time"}
        per_file = rows.select(*PARTITION, "timestamp", *[F.col(f"_metadata.{c}").alias(a) for a, c in about.items()]).groupBy(
            *PARTITION, *about
        ).agg(F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("min_timestamp"), F.max("timestamp").alias("max_timestamp"))
        if landed is None:
            per_file = per_file.withColumn("landed", F.lit(commit.seq).cast("long"))
        else:  # one row per month
            per_file = per_file.join(F.broadcast(landed), PARTITION, "left")
        return per_file.select(
            F.lit("add").alias("op"), F.lit(commit.id).alias(COMMIT), F.lit(commit.seq).cast("long").alias("seq"), "landed", *PARTITION, "path",
            "bytes", "modified", "rows", "min_timestamp", "max_timestamp", F.lit(compacted).alias("compacted"),
            F.lit(columns_of(schema).json()).alias("schema_json"),
        )

    def switch(self, facts: DataFrame, replaces: list[tuple[str, int, int]] = ()) -> None:
        """Name the files of a commit and the months of commits that they replace, in one file."""
        gone = self.spark.createDataFrame([("drop", *unit) for unit in replaces], f"op string, {COMMIT} string, year int, month int")
        with freed_shuffles(self.spark):
            facts.unionByName(gone, allowMissingColumns=True).coalesce(1).write.mode("append").json(self.table)

    # -- upkeep --------------------------------------------------------------

    def vacuum(self, older_than_hours: float = 24.0) -> list[str]:
        """Delete commit folders that no live row names: replaced ones and those of runs that stopped.

        Readers that still hold an old version, and a write under way, need ``older_than_hours``.
        """
        live = {r[0] for r in self.files().select(COMMIT).distinct().collect()}
        latest = (time.time() - older_than_hours * 3600) * 1000
        dead = [
            name for name, at in storage.children(self.spark, self.location).items()
            if name.startswith(f"{COMMIT}=") and name.removeprefix(f"{COMMIT}=") not in live and at <= latest
        ]
        for name in dead:
            storage.delete(self.spark, f"{self.location}/{name}")
        return sorted(dead)

    def repair(self) -> int:
        """Record files that other tools put into ``year=/month=`` folders, and all commits where the manifest is lost.

        The files of one commit have one set of columns, so foreign files are dealt to commits by theirs.
        Returns the number of commits recorded.  Commits beside a manifest that does not name them were never
        switched to and stay out.
        """
        lost = [
            name.removeprefix(f"{COMMIT}=") for name in storage.children(self.spark, self.location) if name.startswith(f"{COMMIT}=")
        ] if self.rows().isEmpty() else []
        for name in sorted(lost):
            folder = f"{self.location}/{COMMIT}={name}"
            made = Commit(name, int(name.split("-")[0]), folder)
            self.switch(self.facts(made, self.spark.read.parquet(folder).schema))
        foreign = [n for n in storage.children(self.spark, self.location) if n.startswith("year=")]
        if not foreign:
            return len(lost)
        listed = (
            self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
            .load([f"{self.location}/{n}" for n in foreign]).select("path")
        )
        groups: dict[str, tuple[list[str], T.StructType]] = {}
        for paths, schema in self._by_columns(sorted(r.path for r in listed.collect())):
            groups.setdefault(schema.json(), ([], schema))[0].extend(paths)
        for paths, schema in groups.values():
            made = self.begin()
            for path in paths:
                storage.move(self.spark, path, f"{made.folder}/{'/'.join(path.split('/')[-3:])}")
            self.switch(self.facts(made, schema))
        return len(lost) + len(groups)

    def _by_columns(self, paths: list[str]) -> list[tuple[list[str], T.StructType]]:
        """Groups of files whose columns can be merged, found by halving."""
        if not paths:
            return []
        try:
            return [(paths, self.spark.read.option("mergeSchema", "true").parquet(*paths).schema)]
        except Exception as drift:
            if "MERGE_SCHEMA" not in str(drift) or len(paths) == 1:
                raise
            half = len(paths) // 2
            return self._by_columns(paths[:half]) + self._by_columns(paths[half:])
