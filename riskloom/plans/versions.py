"""Published tables: versioned folders under a manifest.

A write never touches a file that a reader may hold.  Rows go to a folder of their own
(``data/write=<id>``); the table becomes what they say only when the next manifest
(``versions/<n>.json``: schema, folders by partition value, batches done) appears, by a rename that fails if
that version exists.  A write that dies leaves folders that no manifest names; readers keep the version they
were opened with.  The list of partitions, and so the newest one, is read from the manifest without a scan.

    <table>/data/write=<id>/<column>=<value>/part-*.parquet
    <table>/versions/00000007.json
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_PARTITION = ""  # the one entry of a table without a partition column
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name of a null value


class WriteConflict(RuntimeError):
    """Another writer published a version in the meantime; the rows written are not part of the table."""


@dataclass
class Manifest:
    version: int
    schema: dict
    column: str | None
    parts: dict[str, list[str]] = field(default_factory=dict)  # partition value: folders below data/
    batches: dict[str, int] = field(default_factory=dict)  # writer: last batch it published

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # -- files ------------------------------------------------------------------------

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _text(self, path: str) -> str:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, path: str, text: str) -> None:
        """All of the text under a name that didn't exist, or nothing."""
        jvm = self.spark._jvm
        fs, _ = self._fs(path)
        to = jvm.org.apache.hadoop.fs.Path(path)
        part = jvm.org.apache.hadoop.fs.Path(f"{self.path}/staged/{uuid.uuid4().hex}.json")
        stream = fs.create(part, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        fs.mkdirs(to.getParent())
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(part, to, none)  # refuses an existing name
        except Exception as error:
            fs.delete(part, False)
            if "FileAlreadyExistsException" in str(error):
                raise WriteConflict(path) from None
            raise

    # -- reading ----------------------------------------------------------------------

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names(f"{self.path}/versions") if n.endswith(".json") and not n.startswith(".")]

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The newest version, or a given one; None for a table that was never published."""
        if version is None:
            there = self.versions()
            if not there:
                return None
            version = there[-1]
        return Manifest(**json.loads(self._text(f"{self.path}/versions/{version:08d}.json")))

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None, values: list | None = None) -> DataFrame:
        """The table as of a version; ``values``: only these partitions.  Later writes don't change the frame."""
        m = self.manifest(version)
        if m is None:
            raise FileNotFoundError(f"no published version: {self.path}")
        return self._frame(m, m.parts if values is None else [str(v) for v in values])

    def _frame(self, m: Manifest, values) -> DataFrame:
        folders = sorted({f for v in values for f in m.parts.get(v, [])})
        schema = m.struct()
        if not folders:
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField("write", T.StringType())])
        rows = self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/{f}" for f in folders])
        return rows.select(*[F.col(f"`{n}`") for n in schema.names])

    def partitions(self, version: int | None = None) -> list[str]:
        """Partition values, in order of their text: from the manifest, no scan."""
        m = self.manifest(version)
        return [] if m is None else sorted(v for v in m.parts if v != DEFAULT_PARTITION)

    def newest(self, version: int | None = None, upto: str | None = None) -> str | None:
        """The last partition value (not after ``upto``)."""
        return max((v for v in self.partitions(version) if upto is None or v <= str(upto)), default=None)

    # -- writing ----------------------------------------------------------------------

    def _write(self, df: DataFrame, column: str | None) -> dict[str, list[str]]:
        """The rows' files, as folders by partition value."""
        name = f"write={uuid.uuid4().hex}"
        to = f"{self.path}/data/{name}"
        if column is None:
            df.write.parquet(to)
            return {NO_PARTITION: [name]}
        # few files for a small partition, several for a large one
        df.hint("rebalance", column).write.partitionBy(column).parquet(to)
        return {unquote(n.split("=", 1)[1]): [f"{name}/{n}"] for n in self._names(to) if n.startswith(f"{column}=")}

    def _check(self, df: DataFrame, m: Manifest | None, column: str | None) -> None:
        """SNK1's ``on_schema_change='fail'``: columns and types are those of the table."""
        if m is None:
            return
        flat = lambda s: {f.name: f.dataType.simpleString() for f in s.fields}
        if flat(df.schema) != flat(m.struct()) or column != m.column:
            raise ValueError(f"schema change refused: {flat(df.schema)} by {column} != {flat(m.struct())} by {m.column}")

    def _publish(self, m: Manifest | None, schema: T.StructType, column: str | None, parts: dict, batch: tuple[str, int] | None) -> int:
        version = 1 if m is None else m.version + 1
        batches = dict(m.batches) if m else {}
        if batch:
            batches[batch[0]] = batch[1]
        new = Manifest(version, json.loads(schema.json()), column, parts, batches)
        self._put(f"{self.path}/versions/{version:08d}.json", json.dumps(new.__dict__, sort_keys=True))
        return version

    def _stored(self, df: DataFrame, m: Manifest | None, column: str | None) -> T.StructType:
        """Schema of the table: the partition column last, as files hold the others."""
        if m is not None:
            return m.struct()
        rest = [f for f in df.schema.fields if f.name != column]
        fields = rest + [f for f in df.schema.fields if f.name == column]
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])

    def refresh(self, df: DataFrame, column: str | None = None, batch: tuple[str, int] | None = None) -> int:
        """SNK7: the rows become the whole table."""
        m = self.manifest()
        self._check(df, m, column)
        return self._publish(m, self._stored(df, m, column), column, self._write(df, column), batch)

    def replace(self, df: DataFrame, column: str = "snapshot_date", batch: tuple[str, int] | None = None, empty: list = ()) -> int:
        """SNK1/SNK2: the partitions that the rows hold are replaced, those named in ``empty`` go unless the rows
        hold them, the others stay, as one step."""
        m = self.manifest()
        self._check(df, m, column)
        parts = {v: f for v, f in (m.parts if m else {}).items() if v not in {str(e) for e in empty}}
        return self._publish(m, self._stored(df, m, column), column, parts | self._write(df, column), batch)

    def append(self, df: DataFrame, column: str | None = None, batch: tuple[str, int] | None = None) -> int:
        """SNK4/SNK5: rows are added."""
        m = self.manifest()
        self._check(df, m, column)
        parts = {v: list(f) for v, f in (m.parts if m else {}).items()}
        for v, folders in self._write(df, column).items():
            parts[v] = parts.get(v, []) + folders
        return self._publish(m, self._stored(df, m, column), column, parts, batch)

    def drop(self, values: list) -> int:
        """Partitions go from the next version on; ``vacuum`` deletes their files."""
        m = self.manifest()
        if m is None:
            raise FileNotFoundError(f"no published version: {self.path}")
        gone = {str(v) for v in values}
        return self._publish(m, m.struct(), m.column, {v: f for v, f in m.parts.items() if v not in gone}, None)

    def done(self, writer: str) -> int:
        """The last batch of ``writer`` that the table holds; -1 before the first."""
        m = self.manifest()
        return -1 if m is None else m.batches.get(writer, -1)

    def vacuum(self, keep: int = 2, dry_run: bool = False) -> list[str]:
        """Folders that none of the last ``keep`` versions name, and the older manifests, are deleted (or only
        listed).  Not to be run beside a writer: rows being written are in no manifest yet."""
        there = self.versions()
        held = {f for v in there[-keep:] for fs in self.manifest(v).parts.values() for f in fs}
        gone = []
        for write in self._names(f"{self.path}/data"):
            inner = [n for n in self._names(f"{self.path}/data/{write}") if "=" in n]
            gone += [f for f in ([f"{write}/{n}" for n in inner] if inner else [write]) if f not in held and write not in held]
        if not dry_run:
            paths = [f"data/{f}" for f in gone] + [f"versions/{v:08d}.json" for v in there[:-keep]]
            for p in paths:
                fs, at = self._fs(f"{self.path}/{p}")
                fs.delete(at, True)
        return gone
