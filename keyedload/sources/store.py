"""Tables on disk: a definition, immutable load directories, and a log of published loads.

    <root>/<keyspace>/<table>/spec                     table definition, one JSON line
    <root>/<keyspace>/<table>/data/load_id=<id>/_attempt=<attempt>/_bucket=<b>/*.parquet
    <root>/<keyspace>/<table>/buckets/load_id=<id>/_attempt=<attempt>/*.parquet    loads in Spark's buckets
    <root>/<keyspace>/<table>/commits/<number>.json    one entry per publication, compaction or clean-up

Data is written by Spark's own committers, every attempt in a directory of its own, so no attempt touches another's files.
An entry of the log names the attempt that is published, and gets its number only if nothing has it (``commits.py``): of
racing loads of one id one is published, and what is published never changes. Tables of the earlier layout (``log/*.parquet``,
no attempts) are read too.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyedload.sources.commits import CommitLog, Folder
from keyedload.spec import (
    ATTEMPT,
    BUCKET,
    EXPIRES,
    LOAD_ID,
    TOKEN,
    WRITTEN,
    WTS,
    AlreadyPublished,
    LoadError,
    TableNotFound,
    TableSpec,
)

LOG_SCHEMA = (
    T.StructType()
    .add(LOAD_ID, T.StringType())
    .add("published_at", T.TimestampType())
    .add("load_epoch", T.LongType())
    .add("rows", T.LongType())
    .add("keys", T.LongType())
    .add("most_versions", T.LongType())
    .add("rejected", T.LongType())
    .add("min_wts", T.LongType())
    .add("max_wts", T.LongType())
    .add("has_ttl", T.BooleanType())
    .add("columns", T.ArrayType(T.StringType()))
    .add("partitioner", T.StringType())
    .add("buckets", T.IntegerType())
    .add("ring", T.ArrayType(T.LongType()))
    .add("split_points", T.StringType())
    .add("seconds", T.DoubleType())
)

# An entry is a published load ("load"), one that was replaced ("gone", in checkpoints), or the attempts given up by a clean-up
# ("clean").
ENTRY_SCHEMA = (
    T.StructType(LOG_SCHEMA.fields)
    .add("kind", T.StringType())
    .add("attempt", T.StringType())
    .add("whole", T.BooleanType())
    .add("replaces", T.ArrayType(T.StringType()))
    .add("abandoned", T.ArrayType(T.StringType()))
    .add("hot", T.ArrayType(T.IntegerType()))
    .add("expires", T.LongType())
    .add("index_blocks", T.IntegerType())
)

MUTATION_FIELDS = (
    T.StructType()
    .add(WTS, T.LongType())
    .add(EXPIRES, T.LongType())
    .add(WRITTEN, T.ArrayType(T.StringType()))
    .add(TOKEN, T.LongType())
    .add(LOAD_ID, T.StringType())
    .add(BUCKET, T.IntegerType())
)

_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.\-]*")
_NAME = re.compile(r"[A-Za-z0-9_]+")


@dataclass(frozen=True)
class LogRow:
    """One published load, as the log keeps it."""

    load_id: str
    load_epoch: int
    rows: int
    keys: int | None
    most_versions: int | None
    rejected: int
    min_wts: int | None
    max_wts: int | None
    has_ttl: bool
    columns: tuple[str, ...]
    partitioner: str
    buckets: int
    ring: tuple[int, ...] | None
    split_points: str
    seconds: float
    attempt: str | None = None  # directory of the load's files
    whole: bool = True  # every row has written all of ``columns``
    replaces: tuple[str, ...] = ()  # loads this one was made of
    hot: tuple[int, ...] | None = None  # buckets with far more rows than others, where they were counted
    expires: int | None = None  # newest expiry of its rows, where all expire
    index_blocks: int | None = None  # blocks of keys in the index of each file, where there is one

    @staticmethod
    def from_row(row: Row) -> LogRow:
        values = {f.name: row[f.name] for f in fields(LogRow)}
        values["columns"] = tuple(values["columns"])
        values["ring"] = None if values["ring"] is None else tuple(values["ring"])
        values["replaces"] = tuple(values["replaces"] or ())
        values["whole"] = values["whole"] is not False
        values["hot"] = None if values["hot"] is None else tuple(values["hot"])
        return LogRow(**values)

    def to_json(self) -> str:
        now = dt.datetime.now(dt.timezone.utc).isoformat()
        return json.dumps({"kind": "load", "published_at": now} | {f.name: getattr(self, f.name) for f in fields(self)})

    def alive(self, as_of: int) -> bool:
        """Whether some row may not have expired."""
        return self.expires is None or self.expires > as_of

    @property
    def distinct_keys(self) -> bool:
        return self.keys is not None and self.keys == self.rows


def new_load_id() -> str:
    return uuid.uuid4().hex


def check_load_id(load_id: str) -> str:
    if not _ID.fullmatch(load_id):
        raise ValueError(f"load id {load_id!r} may only have letters, digits, '_', '-' and '.'")
    return load_id


_LOCAL_FOLDERS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """A fresh directory in the folder all executors share, below one folder per application.

    The folder is ``spark.checkpoint.dir``, or the checkpoint directory of the context. Where neither is set a local
    temporary folder serves, but only for a local master: executors elsewhere would not see it.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise LoadError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if app not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="keyedload-")
        shared = _LOCAL_FOLDERS[app]
    return f"{shared.rstrip('/')}/keyedload-{app}/{uuid.uuid4().hex}"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@contextmanager
def catalog_name(spark: SparkSession) -> Iterator[str]:
    """A name in the session's catalog for a table at a path, which is only forgotten afterwards: its files stay."""
    name = f"keyedload_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _depth(row: LogRow) -> int:
    """How the files of a load lie: 1 in its attempt, 2 in its buckets, 3 in buckets without an attempt."""
    return 3 if row.attempt is None else 1 if row.partitioner == "bucketed" else 2


class KeyedStore:
    """A root directory with keyed tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._specs: dict[tuple[str, str], TableSpec] = {}

    def table_path(self, keyspace: str, table: str) -> str:
        for name in (keyspace, table):
            if not _NAME.fullmatch(name):
                raise ValueError(f"{name!r} is not a name of letters, digits and '_'")
        return f"{self.root}/{keyspace}/{table}"

    def data_path(
        self, spec: TableSpec, load_id: str | None = None, attempt: str | None = None, partitioner: str | None = None
    ) -> str:
        # Spark's buckets are files of an attempt, not directories, and are found apart from these.
        base = f"{self.table_path(spec.keyspace, spec.name)}/{'buckets' if partitioner == 'bucketed' else 'data'}"
        if load_id is None:
            return base
        return f"{base}/{LOAD_ID}={load_id}" + (f"/{ATTEMPT}={attempt}" if attempt else "")

    # -- table definitions -------------------------------------------------------------------

    def create_table(self, spec: TableSpec) -> TableSpec:
        """Record a table definition. Raises when the table exists."""
        base = self.table_path(spec.keyspace, spec.name)
        line = self.spark.range(1, numPartitions=1).select(F.lit(spec.to_json()).alias("value"))
        try:
            line.write.text(f"{base}/spec")
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            raise LoadError(f"table {spec.full_name} exists already") from e
        self._specs[spec.keyspace, spec.name] = spec
        return spec

    def spec(self, keyspace: str, table: str) -> TableSpec:
        """Definition of a table. Definitions never change, so a store reads each once."""
        known = self._specs.get((keyspace, table))
        if known is not None:
            return known
        path = f"{self.table_path(keyspace, table)}/spec"
        try:
            lines = self.spark.read.text(path).limit(1).collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            lines = []
        if not lines:
            raise TableNotFound(f"table {keyspace}.{table} not found")
        found = self._specs[keyspace, table] = TableSpec.from_json(lines[0].value)
        return found

    # -- log of published loads --------------------------------------------------------------

    def commits(self, spec: TableSpec) -> CommitLog:
        return CommitLog(self.spark, f"{self.table_path(spec.keyspace, spec.name)}/commits", ENTRY_SCHEMA)

    def entries(self, spec: TableSpec) -> tuple[DataFrame, int]:
        """All entries of the log, and the number of the last."""
        found, last = self.commits(spec).read()
        parts = [found] if found is not None else []
        earlier = Folder(self.spark, f"{self.table_path(spec.keyspace, spec.name)}/log")
        if earlier.exists():
            rows = self.spark.read.schema(LOG_SCHEMA).parquet(earlier.path).dropDuplicates([LOAD_ID])
            parts.append(rows.withColumn("kind", F.lit("load")))
        if not parts:
            return self.spark.createDataFrame([], ENTRY_SCHEMA), last
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), last

    def summed(self, entries: DataFrame) -> DataFrame:
        """The entries as they stand now: loads that others replaced are gone, since then."""
        loads = entries.where("kind = 'load'")
        replaced = loads.select(F.explode("replaces").alias(LOAD_ID), F.col("published_at").alias("_since"))
        live = loads.join(replaced, LOAD_ID, "left_anti").withColumn("replaces", F.array().cast("array<string>"))
        gone = loads.join(replaced, LOAD_ID).withColumn("published_at", F.col("_since")).withColumn("kind", F.lit("gone"))
        columns = ENTRY_SCHEMA.names
        out = live.select(columns).unionByName(gone.select(columns).withColumn("replaces", F.lit(None).cast("array<string>")))
        return out.unionByName(entries.where("kind <> 'load'").select(columns))

    def log(self, spec: TableSpec) -> DataFrame:
        """Published loads, one row each, without those that others have replaced."""
        return self.summed(self.entries(spec)[0]).where("kind = 'load'").select(LOG_SCHEMA.names)

    def published(self, spec: TableSpec) -> list[LogRow]:
        """The published loads as driver objects: one row of metadata per load, however many there are."""
        rows = self.entries(spec)[0].where("kind = 'load'").collect()
        replaced = {i for r in rows for i in r["replaces"] or ()}
        return list({r[LOAD_ID]: LogRow.from_row(r) for r in rows if r[LOAD_ID] not in replaced}.values())

    def is_published(self, spec: TableSpec, load_id: str) -> bool:
        """Whether a load of that id was ever published, replaced or not."""
        return bool(self.entries(spec)[0].where(F.col(LOAD_ID) == load_id).limit(1).count())

    def publish(self, spec: TableSpec, row: LogRow) -> None:
        """Make a written load visible: one entry of the log, which also takes away the loads it replaces.

        Publishing an attempt again changes nothing. Raises ``AlreadyPublished`` when another attempt of the load's id was
        first, and ``LoadError`` when a load to replace is no longer there or a clean-up has given the attempt up.
        """
        ids = [F.lit(i) for i in (row.load_id, *row.replaces)]
        given_up = F.exists("abandoned", lambda a: a == F.lit(row.attempt or ""))
        touched = F.col(LOAD_ID).isin(ids) | F.exists("replaces", lambda i: i.isin(ids)) | given_up
        while True:
            entries, last = self.entries(spec)
            found = (entries.where(touched) if len(ids) <= 1000 else entries).select(
                "kind", LOAD_ID, "attempt", "replaces", "abandoned"
            ).collect()
            replaced = {i for r in found for i in r["replaces"] or ()} | {r[LOAD_ID] for r in found if r["kind"] == "gone"}
            known = {r[LOAD_ID]: r["attempt"] for r in found if r["kind"] in ("load", "gone")}
            if row.load_id in known:
                if known[row.load_id] == row.attempt:
                    return
                raise AlreadyPublished(f"load {row.load_id} of {spec.full_name} is published already")
            if any(row.attempt in (r["abandoned"] or ()) for r in found):
                raise LoadError(f"load {row.load_id} of {spec.full_name} was cleaned up before it was published")
            missing = [i for i in row.replaces if i not in known or i in replaced]
            if missing:
                raise LoadError(f"{spec.full_name}: loads {', '.join(missing[:5])} were replaced meanwhile")
            if self.commits(spec).add(last + 1, row.to_json()):
                return

    def drop_attempt(self, spec: TableSpec, load_id: str, attempt: str) -> None:
        """Removes the files of an attempt that will not be published."""
        for partitioner in (None, "bucketed"):
            data = Folder(self.spark, self.data_path(spec, partitioner=partitioner))
            data.remove(f"{LOAD_ID}={load_id}/{ATTEMPT}={attempt}")
            data.remove_if_empty(f"{LOAD_ID}={load_id}")

    # -- data --------------------------------------------------------------------------------

    def read_schema(self, spec: TableSpec) -> T.StructType:
        """Columns of a mutation row. Columns a load did not write read as null."""
        return T.StructType(spec.schema.fields + MUTATION_FIELDS.fields)

    def loads(self, spec: TableSpec, loads: Sequence[LogRow | str], files: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
        """Mutation rows of loads, given as rows of the log or by the ids of published ones; no other directory is listed.

        Of loads that ``files`` names only those files are opened.
        """
        files = files or {}
        named = {i for i in loads if isinstance(i, str)}
        rows = [r for r in loads if isinstance(r, LogRow)]
        if named:
            rows += [r for r in self.published(spec) if r.load_id in named]
        parts = []
        # Directories of one depth can be read together.
        for depth in (1, 2, 3):
            some = [r for r in rows if _depth(r) == depth]
            if some:
                schema = self.read_schema(spec)
                if depth < 3:
                    schema = T.StructType([*schema.fields, T.StructField(ATTEMPT, T.StringType())])
                kind = some[0].partitioner if depth == 1 else None
                whole = {r.load_id: self.data_path(spec, r.load_id, r.attempt, kind) for r in some}
                paths = [f"{path}/{f}" if f else path for i, path in whole.items() for f in files.get(i, [""])]
                found = self.spark.read.schema(schema).option("basePath", self.data_path(spec, partitioner=kind)).parquet(*paths)
                if any(r.rejected for r in some):
                    found = found.where(F.col(BUCKET) >= 0)
                parts.append(found.drop(ATTEMPT))
        if not parts:
            return self.spark.createDataFrame([], self.read_schema(spec))
        return reduce(DataFrame.unionByName, parts)

    def bucketed(self, spec: TableSpec, loads: Sequence[LogRow]) -> DataFrame:
        """Mutation rows of loads in equally many Spark buckets, read bucket by bucket: rows of a partition key are together.

        Spark knows buckets by tables of its catalog, so the directory is one for a moment. All its load directories are
        listed, only the files of ``loads`` are read.
        """
        schema = T.StructType([*self.read_schema(spec).fields, T.StructField(ATTEMPT, T.StringType())])
        with catalog_name(self.spark) as name:
            columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
            key = ", ".join(quoted(c) for c in spec.partition_key)
            path = self.data_path(spec, partitioner="bucketed").replace("'", "\\'")
            # Loads and attempts are found as partitions when the table is read; the catalog knows none, and can forget it.
            buckets = f"CLUSTERED BY ({key}) INTO {loads[0].buckets} BUCKETS"
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {buckets} LOCATION '{path}'")
            rows = self.spark.table(name)
            wanted = F.col(LOAD_ID).isin([r.load_id for r in loads]) & F.col(ATTEMPT).isin([r.attempt for r in loads])
            return rows.where(wanted & (F.col(BUCKET) >= 0)).select(*map(quoted, self.read_schema(spec).names))
