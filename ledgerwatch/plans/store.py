"""Snapshot storage: versioned Parquet tables published by numbered manifests.

File tables cannot be updated in place, and overwriting a path that is being
read loses data. So every table version is written once to a folder of its
own, ``<root>/<table>/v=<n>-<token>/``, and a small JSON manifest names the
current version of every table plus the watermarks. Publishing writes the
manifest with the next number under a temporary name and renames it to
``_manifest-<number>.json``, which must not exist yet. Older manifests are not
touched, so data and watermarks become visible together or not at all, and of
two writers that started from the same manifest the second is refused.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

MANIFEST = "_manifest-{:010d}.json"
_NAME = re.compile(r"_manifest-(\d{10,})\.json$")
#: The one manifest of warehouses written before manifests had numbers.
_OLD_MANIFEST = "_manifest.json"
#: Manifests kept besides the current one.
KEPT = 20


class StaleWriter(RuntimeError):
    """Another writer published after this one read the manifest."""


# --------------------------------------------------------------- filesystem
def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def write_text_new(spark: SparkSession, path: str, text: str) -> None:
    """Write to a temporary sibling, then rename to ``path``; FileExistsError if that exists."""
    fs, p, jvm = _fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(tmp, False)
        raise FileExistsError(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(
        getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    try:
        # Without the overwrite option this fails if another writer was faster.
        context.rename(tmp, p, options)
    except Exception as e:
        fs.delete(tmp, False)
        if "FileAlreadyExists" in str(e):
            raise FileExistsError(path) from e
        raise OSError(f"could not publish {path}") from e


def list_names(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """(name, is a folder) of the entries of a folder; empty if it does not exist."""
    fs, p, _ = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return [(st.getPath().getName(), bool(st.isDirectory())) for st in fs.listStatus(p)]


def remove(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def has_data_files(spark: SparkSession, path: str) -> bool:
    """True when a written folder holds at least one Parquet file (metadata only)."""
    fs, p, _ = _fs(spark, path)
    it = fs.listFiles(p, True)
    while it.hasNext():
        if it.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p, jvm = _fs(spark, src)
    d = jvm.org.apache.hadoop.fs.Path(dst)
    fs.mkdirs(d.getParent())
    return bool(fs.rename(p, d))


# ----------------------------------------------------------------- warehouse
class Warehouse:
    """Versioned tables + watermarks under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        names = list_names(spark, self.root)
        numbers = sorted(int(m[1]) for n, _ in names if (m := _NAME.match(n)))
        self._old = numbers
        current = MANIFEST.format(numbers[-1]) if numbers else _OLD_MANIFEST
        text = read_text(spark, f"{self.root}/{current}")
        if text is None and any(folder and not n.startswith(("_", ".")) for n, folder in names):
            raise RuntimeError(f"{self.root} holds table folders but no manifest: it is not an empty warehouse")
        self.manifest = json.loads(text) if text else {"tables": {}, "watermarks": {}, "run": 0}
        self._exists = text is not None
        self._pending: dict[str, int | str] = {}

    def _open(self) -> None:
        """The first manifest is published before any table folder is made, so a folder
        never lies beside no manifest."""
        if not self._exists:
            self.publish()

    # tables
    def version(self, table: str) -> int | str | None:
        return self._pending.get(table, self.manifest["tables"].get(table))

    def _next_version(self, table: str) -> str:
        """Numbers rise for good, also after a reset; the token keeps two writers apart."""
        last = self.manifest.setdefault("last_version", {})
        number = max(last.get(table, 0), int(str(self.version(table) or 0).split("-")[0])) + 1
        last[table] = number
        return f"{number}-{uuid.uuid4().hex[:8]}"

    def read(self, table: str, schema=None) -> DataFrame | None:
        v = self.version(table)
        if v is None:
            return None if schema is None else self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.root}/{table}/v={v}")

    def stage(self, table: str, df: DataFrame, append_to: DataFrame | None = None,
              partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write a new version of ``table`` (not yet visible to others)."""
        self._open()
        v = self._next_version(table)
        path = f"{self.root}/{table}/v={v}"
        out = df if append_to is None else append_to.unionByName(df)
        w = out.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        self._pending[table] = v
        return self.spark.read.schema(out.schema).parquet(path)

    def append(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Append-only tables keep one folder and add files: old files are
        never rewritten, and readers only see files named in the manifest's
        batch list."""
        self._open()
        path = f"{self.root}/{table}/batch={self.manifest['run'] + 1}-{uuid.uuid4().hex[:8]}"
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        if has_data_files(self.spark, path):
            batches = list(self.manifest.setdefault("batches", {}).get(table, []))
            batches.append(path)
            self.manifest["batches"][table] = batches
        return self.spark.read.schema(df.schema).parquet(path)

    def read_append(self, table: str, schema, besides: list[str] = ()) -> DataFrame:
        """All committed batches of an append-only table but ``besides``, projected to
        ``schema`` (partition columns are discovered from the folders)."""
        paths = [p for p in self.manifest.get("batches", {}).get(table, []) if p not in set(besides)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*paths)
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])

    def compact(self, table: str, schema, partition_by: tuple[str, ...] = ()) -> int:
        """Rewrite all committed batches of an append-only table as one batch
        and publish it. Rows are unchanged; old folders stay until the new
        manifest is visible and are then simply unreferenced. Returns the
        number of batches replaced."""
        paths = list(self.manifest.get("batches", {}).get(table, []))
        if len(paths) <= 1:
            return 0
        df = self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*paths)
        cols = [f.name for f in schema.fields] + [c for c in partition_by if c not in schema.names]
        df = df.select(*cols)
        if partition_by:
            # Range on the partition columns plus a high-cardinality column:
            # few files per partition value, and a hot value still spans
            # several tasks instead of one.
            df = df.repartitionByRange(*partition_by, schema.fields[0].name)
        path = f"{self.root}/{table}/batch=c{self.manifest['run'] + 1}-{uuid.uuid4().hex[:8]}"
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        self.manifest["batches"][table] = [path] if has_data_files(self.spark, path) else []
        reported = self.manifest.get("alerts", {}).get("batches", {})
        if set(paths) <= set(reported.get(table, [])):
            reported[table] = [path]  # nothing in it is new to the counted report
        self.publish()
        return len(paths)

    # watermarks
    def watermark(self, table: str) -> str | None:
        return self.manifest["watermarks"].get(table)

    def set_watermark(self, table: str, value: str | None) -> None:
        if value is not None:
            self.manifest["watermarks"][table] = value

    def reset(self) -> None:
        """Empty every table and set watermarks back to the epoch by
        publishing an empty manifest; old files stay but are unreachable."""
        self.manifest = {"tables": {}, "watermarks": {}, "batches": {}, "run": self.manifest.get("run", 0),
                         "last_version": self.manifest.get("last_version", {})}
        self._pending = {}
        self.publish()

    def publish(self) -> None:
        """Make everything staged visible. Raises StaleWriter, and leaves the published state
        as it is, if the manifest is no longer the one that was read."""
        new = json.loads(json.dumps(self.manifest))
        new["tables"].update(self._pending)
        new["run"] = new.get("run", 0) + 1
        try:
            write_text_new(self.spark, f"{self.root}/{MANIFEST.format(new['run'])}", json.dumps(new, indent=1))
        except FileExistsError as e:
            raise StaleWriter(f"manifest {new['run']} of {self.root} was published by another writer") from e
        self.manifest, self._pending, self._exists = new, {}, True
        self._old.append(new["run"])
        while len(self._old) > KEPT + 1:
            remove(self.spark, f"{self.root}/{MANIFEST.format(self._old.pop(0))}")
