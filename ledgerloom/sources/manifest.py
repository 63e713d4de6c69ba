"""A stored table whose parts are listed in a manifest.

Parts are folders of Parquet files. The manifest names the folder and the tier of every part and the changes applied so far, and
is replaced in one step, so readers see the table before a change or after it. A change writes new folders only for the parts it
touches; other files are not opened and keep their names. What a run that stopped has left behind is in no manifest: it is
never read, and ``remove_unlisted`` deletes it. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.storage import Folder

NAME = "MANIFEST"
PART = "_part"
CHANGES = 1000  # change ids that are remembered
ACTIVE = "active"


@dataclass
class Manifest:
    """``parts`` maps a part to its folder and tier."""

    parts: dict[str, tuple[str, str]] = field(default_factory=dict)
    changes: list[str] = field(default_factory=list)

    def names(self, tier: str | None = None) -> list[str]:
        return sorted(n for n, (_, t) in self.parts.items() if tier in (None, t))


class StoredTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.folder = Folder(spark, self.root)

    def manifest(self) -> Manifest:
        if not self.folder.exists(NAME):
            return Manifest()
        stored = json.loads(self.folder.read_text(NAME))
        return Manifest({n: tuple(p) for n, p in stored["parts"].items()}, stored["changes"])

    def read(self, names: list[str] | None = None, tier: str | None = None) -> DataFrame:
        """The rows of some parts (of all parts of a tier); only their folders are listed and opened."""
        manifest = self.manifest()
        wanted = [n for n in manifest.names(tier) if names is None or n in names]
        folders = [manifest.parts[n][0] for n in wanted]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def write(self, rows: DataFrame, part: Column, root: str | None = None) -> dict[str, str]:
        """Write rows to fresh folders, one for each part: part to folder. Nothing refers to them yet. Rows of a part are spread
        over tasks by their values, so that a large part is written by many."""
        base = f"data/{uuid.uuid4().hex}"
        target = Folder(self.spark, root or self.root)
        placed = rows.select(*self.schema.names, part.cast("string").alias(PART))
        spread = [c for c, t in rows.dtypes if c in self.schema.names and "map<" not in t]
        placed = placed.repartitionByRange(PART, *spread).sortWithinPartitions(PART, *spread)
        placed.write.partitionBy(PART).parquet(f"{target.path}/{base}")
        prefix = f"{PART}="
        return {n[len(prefix):]: f"{target.path}/{base}/{n}" for n in target.folders(base) if n.startswith(prefix)}

    def switch(self, manifest: Manifest) -> None:
        """From now on readers see this manifest."""
        stored = {"parts": {n: list(p) for n, p in sorted(manifest.parts.items())}, "changes": manifest.changes[-CHANGES:]}
        self.folder.write_text(NAME, json.dumps(stored))

    def create(self, rows: DataFrame, part: Column) -> None:
        """Replace the whole table."""
        self.switch(Manifest({n: (f, ACTIVE) for n, f in self.write(rows, part).items()}))

    def rewrite(self, names: list[str], change: Callable[[DataFrame], DataFrame], part: Column, change_id: str) -> list[str]:
        """Change the rows of some parts, which they must not leave, once for each id: the parts that were written anew."""
        manifest = self.manifest()
        if change_id in manifest.changes:
            return []
        touched = [n for n in manifest.names() if n in set(names)]
        written = self.write(change(self.read(touched)), part) if touched else {}
        if not set(written) <= set(touched):
            raise ValueError(f"rows moved to parts {sorted(set(written) - set(touched))}")
        kept = {n: p for n, p in manifest.parts.items() if n not in touched}
        tiers = {n: manifest.parts[n][1] for n in touched}
        self.switch(Manifest(kept | {n: (f, tiers[n]) for n, f in written.items()}, [*manifest.changes, change_id]))
        return touched

    def move(self, names: list[str], tier: str, root: str, part: Column) -> list[str]:
        """Copy parts to another root by one job, then let the manifest name the copies, all in one step."""
        manifest = self.manifest()
        moving = [n for n in manifest.names() if n in set(names) and manifest.parts[n][1] != tier]
        if moving:
            copies = {n: (f, tier) for n, f in self.write(self.read(moving), part, root).items()}
            empty = {n: p for n, p in manifest.parts.items() if n in moving and n not in copies}
            self.switch(Manifest({n: p for n, p in manifest.parts.items() if n not in moving} | empty | copies, manifest.changes))
        return moving

    def remove_unlisted(self, *roots: str) -> list[str]:
        """Delete the folders that no part of the manifest is in: old versions, and what stopped runs have left."""
        listed = {folder for folder, _ in self.manifest().parts.values()}
        removed = []
        for root in (self.root, *roots):
            target = Folder(self.spark, root)
            for run in target.folders("data"):
                for name in target.folders(f"data/{run}"):
                    if f"{target.path}/data/{run}/{name}" not in listed:
                        target.remove(f"data/{run}/{name}")
                        removed.append(f"{target.path}/data/{run}/{name}")
                if not target.folders(f"data/{run}"):
                    target.remove(f"data/{run}")
        return removed


def hashed_part(keys: list[str], parts: int) -> Column:
    """The part of a row by its keys, as text."""
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("string")
