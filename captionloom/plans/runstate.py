"""Resumable stages: a stage table by source, and a run manifest that names the configuration it was made with."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captionloom.sources.readers import pending
from captionloom.sources.sinks import read_by_source, write_by_source

MANIFEST = "stage string, config_sha256 string, config string, video_id string"


def config_hash(config: dict) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).json(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], MANIFEST)


def check_compatible(manifest: DataFrame, stage: str, config: dict) -> None:
    """Fails if the stage has been run with another configuration."""
    other = manifest.where((F.col("stage") == stage) & (F.col("config_sha256") != config_hash(config)))
    found = other.select("config").limit(1).collect()
    if found:
        raise ValueError(f"stage {stage} was run with another configuration: {found[0].config}")


def run_stage(
    spark: SparkSession, root: str, stage: str, config: dict, sources: DataFrame, compute: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Runs compute for the sources that the manifest lacks, and returns the stage's whole table.

    A source enters the manifest only after its rows are written; a run that is broken off leaves complete sources
    and no others, and the next run goes on with the rest.
    """
    path = f"{root}/_runs"
    manifest = read_manifest(spark, path)
    check_compatible(manifest, stage, config)
    todo = pending(sources, manifest.where(F.col("stage") == stage))
    if not todo.isEmpty():
        write_by_source(compute(todo), f"{root}/{stage}")
        entry = todo.select(F.lit(stage).alias("stage"), F.lit(config_hash(config)).alias("config_sha256"), F.lit(json.dumps(config, sort_keys=True)).alias("config"), "video_id")
        entry.write.mode("append").json(path)
    return read_by_source(spark, f"{root}/{stage}")


class Conflict(RuntimeError):
    """Another writer has committed the version that this one was to be."""


@dataclass(frozen=True)
class Version:
    number: int
    stage: str
    config_sha256: str
    config: str
    path: str


class VersionedState:
    """Stage tables below a folder in numbered versions, each the rows and sources of one commit.

    A commit stages its tables in a folder that no version names, and then renames one small file to the next version's name.
    That rename fails where the name is taken, so of two writers that started from the same version one gets Conflict and
    nothing of its work is seen. (It is as atomic as the file system's rename without overwriting.) Readers see whole versions or
    nothing of them; what a broken run has staged stays invisible.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._fs, self._jvm = spark._jvm.org.apache.hadoop.fs, spark._jvm
        conf = spark._jsc.hadoopConfiguration()
        self._context = self._fs.FileContext.getFileContext(self._fs.Path(self.root).toUri(), conf)
        self._files = self._fs.Path(self.root).getFileSystem(conf)
        self._files.mkdirs(self._path("versions"))

    def _path(self, *names: str):
        return self._fs.Path("/".join((self.root, *names)))

    def versions(self) -> list[Version]:
        """All versions, oldest first. Files that are not named like a version are passed over."""
        names = sorted(f.getPath().getName() for f in self._files.listStatus(self._path("versions")))
        out = []
        for name in (n for n in names if n.endswith(".json") and n[:-5].isdigit()):
            stream = self._files.open(self._path("versions", name))
            try:
                text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            out.append(Version(int(name[:-5]), **json.loads(text)))
        return out

    def latest(self) -> int:
        return max((v.number for v in self.versions()), default=0)

    def _tables(self, stage: str, table: str) -> list[tuple[int, str]]:
        return [(v.number, f"{self.root}/{v.path}/{table}") for v in self.versions() if v.stage == stage]

    def rows(self, stage: str) -> DataFrame | None:
        """The stage's rows of all versions, with the column version; None before the first."""
        parts = [self.spark.read.parquet(path).withColumn("version", F.lit(n)) for n, path in self._tables(stage, "rows")]
        return self._union(parts)

    def done(self, stage: str) -> DataFrame:
        parts = [self.spark.read.schema("video_id string").parquet(path) for _, path in self._tables(stage, "sources")]
        return self._union(parts) if parts else self.spark.createDataFrame([], "video_id string")

    @staticmethod
    def _union(parts: list[DataFrame]) -> DataFrame | None:
        out = parts[0] if parts else None
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def check(self, stage: str, config: dict) -> None:
        """Fails if the stage has a version of another configuration."""
        for v in self.versions():
            if v.stage == stage and v.config_sha256 != config_hash(config):
                raise ValueError(f"stage {stage} was run with another configuration: {v.config}")

    def commit(self, base: int, stage: str, config: dict, sources: DataFrame, rows: DataFrame) -> int:
        """Writes the sources and their rows as the version after base; Conflict where that is no longer the next one."""
        name = uuid.uuid4().hex
        try:
            rows.write.parquet(f"{self.root}/staged/{name}/rows")
            sources.select("video_id").write.parquet(f"{self.root}/staged/{name}/sources")
            entry = {"stage": stage, "config_sha256": config_hash(config), "config": json.dumps(config, sort_keys=True), "path": f"data/{name}"}
            stream = self._files.create(self._path("staged", f"{name}.json"), False)
            stream.write(bytearray(json.dumps(entry).encode()))
            stream.close()
            self._files.mkdirs(self._path("data"))
            self._rename(self._path("staged", name), self._path("data", name))
            self._rename(self._path("staged", f"{name}.json"), self._path("versions", f"{base + 1:08d}.json"))
        except BaseException as e:
            for left in (("staged", name), ("staged", f"{name}.json"), ("data", name)):
                self._files.delete(self._path(*left), True)
            if "FileAlreadyExistsException" in str(e):
                raise Conflict(f"version {base + 1} of {self.root} is there already") from e
            raise
        return base + 1

    def _rename(self, old, new) -> None:
        options = self.spark.sparkContext._gateway.new_array(getattr(self._fs, "Options$Rename"), 1)
        options[0] = getattr(self._fs, "Options$Rename").NONE
        self._context.rename(old, new, options)


def run_versioned(state: VersionedState, stage: str, config: dict, batches: list[DataFrame], compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Runs compute for each batch of sources, less those that are done, and commits each as a version of its own. A run that breaks
    off keeps its commits, and the next one goes on with the sources that they lack."""
    state.check(stage, config)
    for sources in batches:
        base = state.latest()
        todo = pending(sources, state.done(stage))
        if not todo.isEmpty():
            state.commit(base, stage, config, todo, compute(todo))
    return state.rows(stage)
