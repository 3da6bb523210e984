"""A versioned lake of Parquet artifacts with a manifest table.

Layout: ``<root>/<layer>/<name>/version=<yyyymmddHHMMSS>/`` and ``<root>/_manifest``.
"""

from __future__ import annotations

import fnmatch
import json
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.sources.files import path_exists
from claimloom.sources.uris import opened

# The layers.
LAYERS = ("raw", "processed", "embeddings")
# Bytes of a raw file in one row.
CHUNK = 16 * 1024 * 1024
# Such rows in one file of the lake.
CHUNKS_IN_FILE = 4
# Bytes that one task copies.
TASK_BYTES = 512 * 1024 * 1024
MANIFEST = "layer string, name string, version string, path string, metadata map<string,string>"


def current_version() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S")


def _text(value) -> str:
    return json.dumps(value) if isinstance(value, bool) else str(value)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of files from ``at`` on, CHUNK of them or up to ``length``; a file that has changed since it was listed is an error."""
    for batch in batches:
        for path, length, at in zip(*(batch[c].to_pylist() for c in ("path", "length", "at"))):
            want = min(CHUNK, length - at)
            store, name = opened(path)
            with store.open_input_file(name) as file:
                file.seek(at)
                content = file.read(want)
            if len(content) != want:
                raise OSError(f"{path} is shorter than when it was listed")
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([at], pa.int64()), pa.array([content], pa.binary())], ["path", "at", "content"])


class Lake:
    """Writes are errors when the same artifact and version exist; system keys win over user keys."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def manifest_path(self) -> str:
        return f"{self.root}/_manifest"

    def _layer(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer: {layer}")
        return layer

    def path(self, layer: str, name: str, version: str) -> str:
        return f"{self.root}/{self._layer(layer)}/{name}/version={version}"

    def _record(self, layer: str, name: str, version: str, path: str, metadata: dict | None, system: dict) -> str:
        keys = {**(metadata or {}), **system, "version": version, "layer": layer}
        row = (layer, name, version, path, {k: _text(v) for k, v in keys.items()})
        self.spark.createDataFrame([row], MANIFEST).write.mode("append").parquet(self.manifest_path)
        return path

    def put_raw(self, source: str, metadata: dict | None = None, name: str | None = None, version: str | None = None) -> str:
        """Keep the original files in the raw layer, as ``path, at, content`` rows of at most CHUNK bytes each.

        Files are listed with their lengths, and each range of CHUNK bytes is read by the task that writes it, so
        a file of any size is copied by many tasks and held whole by none. ``content`` in the order of ``at`` is the file.
        An empty file has no chunk (Spark does not list it).
        """
        if not path_exists(self.spark, source):
            raise FileNotFoundError(f"source path not found: {source}")
        version = version or current_version()
        name = name or source.rstrip("/").rpartition("/")[2]
        target = self.path("raw", name, version)
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source).select("path", "length")
        total = files.agg(F.sum("length")).first()[0] or 0
        starts = F.explode(F.sequence(F.lit(0), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(CHUNK)))
        places = files.select("path", "length", starts.alias("at")).repartition(max(1, -(-total // TASK_BYTES)), "path", "at")
        rows = places.mapInArrow(_ranges, "path string, at long, content binary")
        # readers take all rows of a small file at once
        rows.write.mode("errorifexists").option("maxRecordsPerFile", CHUNKS_IN_FILE).parquet(target)
        system = {"source_path": source, "uploaded_at": _now(), "filename": name}
        return self._record("raw", name, version, target, metadata, system)

    def put_table(
        self, df: DataFrame, name: str, metadata: dict | None = None, version: str | None = None, layer: str = "processed"
    ) -> str:
        """Write a table; its row count is read from the Parquet footers, not by a second pass."""
        version = version or current_version()
        target = self.path(layer, name, version)
        df.write.mode("errorifexists").parquet(target)
        rows = self.spark.read.parquet(target).count()
        system = {"name": name, "saved_at": _now(), "rows": rows, "columns": len(df.columns)}
        return self._record(layer, name, version, target, metadata, system)

    def put_vectors(self, vectors: DataFrame, name: str, metadata: dict | None = None, version: str | None = None) -> str:
        """Store word or document vectors."""
        return self.put_table(vectors, name, metadata, version, "embeddings")

    def manifest(self) -> DataFrame:
        if not path_exists(self.spark, self.manifest_path):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(self.manifest_path)

    def artifacts(self, layer: str, version: str | None = None, pattern: str = "*") -> DataFrame:
        """Manifest rows of a layer; ``pattern`` is a glob on the artifact name."""
        rows = self.manifest().where(F.col("layer") == self._layer(layer))
        if version is not None:
            rows = rows.where(F.col("version") == version)
        return rows.where(F.col("name").rlike("^" + fnmatch.translate(pattern).replace(r"\Z", "$").replace(r"\z", "$")))

    def fetch(self, layer: str = "processed", version: str | None = None, pattern: str = "*") -> DataFrame | None:
        """All matching artifacts as one table with ``name`` and ``version``; None when there are none.

        Artifacts of different shape are united by column name. ``version`` is a
        partition column, so asking for one reads only its folder.
        """
        names = sorted({r["name"] for r in self.artifacts(layer, version, pattern).select("name").distinct().collect()})
        out = None
        for name in names:
            # versions of one artifact may have columns of their own
            table = self.spark.read.option("mergeSchema", True).parquet(f"{self.root}/{layer}/{name}")
            table = table.withColumn("version", F.col("version").cast("string")).withColumn("artifact", F.lit(name))
            if version is not None:
                table = table.where(F.col("version") == version)
            out = table if out is None else out.unionByName(table, allowMissingColumns=True)
        return out

    def list_versions(self, layer: str | None = None) -> DataFrame:
        layers = [self._layer(layer)] if layer else list(LAYERS)
        return versions_by_layer(self.manifest(), layers)

    def metadata_json(self) -> DataFrame:
        """``path, metadata`` with the metadata as a JSON text, for export next to the data."""
        return self.manifest().select("path", F.to_json("metadata").alias("metadata"))


def versions_by_layer(manifest: DataFrame, layers=LAYERS) -> DataFrame:
    """``layer, versions`` in ascending order; a layer without artifacts has an empty list."""
    known = manifest.sparkSession.createDataFrame([(x,) for x in layers], "layer string")
    found = manifest.select("layer", "version").distinct().groupBy("layer").agg(
        F.array_sort(F.collect_list("version")).alias("versions")
    )
    return known.join(found, "layer", "left").select(
        "layer", F.coalesce("versions", F.array().cast("array<string>")).alias("versions")
    )


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
