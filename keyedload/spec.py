"""Table definitions, load settings and the errors raised by the loader."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Columns the loader adds to the files of a table. User columns may not use these names.
WTS = "_wts"  # write timestamp, microseconds since the epoch
EXPIRES = "_expires_at"  # second since the epoch at which the row expires, null = never
WRITTEN = "_set"  # columns a partial load has written, null = all columns
TOKEN = "_token"  # placement token of the partition key
BUCKET = "_bucket"  # token range that owns the row, a directory level on disk
LOAD_ID = "load_id"  # load that wrote the row, a directory level on disk
ATTEMPT = "_attempt"  # attempt whose files are published, a directory level on disk
REJECTED = "_rejected"  # a row that was set aside, as it came in
SYSTEM_COLUMNS = (WTS, EXPIRES, WRITTEN, TOKEN, BUCKET, LOAD_ID, ATTEMPT, REJECTED)

# Expiry of what never expires.
NEVER = 2**63 - 1

PARTITIONERS = ("hash", "md5", "ordered", "bucketed")
BAD_VALUE_MODES = ("fail", "reject")

# A session setting with this value means "no limit" / "no expiry".
UNSET_INT = 2**31 - 1

CONF_PREFIX = "spark.keyedload."


class LoadError(Exception):
    """A load or a read could not be carried out."""


class AlreadyPublished(LoadError):
    """Another attempt of the load was published first."""


class TableNotFound(LoadError):
    """The named table has not been created in this store."""


class ContractError(LoadError, ValueError):
    """The input columns do not fit the table."""


@dataclass(frozen=True)
class TableSpec:
    """A keyed table: ordered columns, partition key and clustering columns.

    ``schema`` may be a ``StructType`` or a DDL string; ``clustering`` entries are a name
    (ascending) or a ``(name, "asc" | "desc")`` pair.
    """

    keyspace: str
    name: str
    schema: T.StructType
    partition_key: tuple[str, ...]
    clustering: tuple[tuple[str, str], ...] = ()

    def __post_init__(self) -> None:
        schema = self.schema
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        # Spark keeps no NOT NULL in Parquet, and a cell may always be deleted.
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        clustering = tuple((c, "asc") if isinstance(c, str) else (c[0], c[1].lower()) for c in self.clustering)
        object.__setattr__(self, "schema", schema)
        object.__setattr__(self, "partition_key", tuple(self.partition_key))
        object.__setattr__(self, "clustering", clustering)

        names = schema.names
        if len(set(names)) != len(names):
            raise ValueError(f"{self.full_name}: duplicate column names")
        if len({c.lower() for c in names}) != len(names):
            raise ValueError(f"{self.full_name}: column names that differ only in case")
        reserved = {c for c in names if c.lower() in SYSTEM_COLUMNS}
        if reserved:
            raise ValueError(f"{self.full_name}: reserved column names {sorted(reserved)}")
        if not self.partition_key:
            raise ValueError(f"{self.full_name}: a partition key is required")
        if len(set(self.key)) != len(self.key):
            raise ValueError(f"{self.full_name}: a column occurs twice in the primary key")
        unknown = [c for c in self.key if c not in names]
        if unknown:
            raise ValueError(f"{self.full_name}: key columns {unknown} are not columns of the table")
        for column, direction in clustering:
            if direction not in ("asc", "desc"):
                raise ValueError(f"{self.full_name}: clustering order of {column} must be asc or desc")
        for column in self.key:
            if isinstance(schema[column].dataType, T.ArrayType) or "map<" in schema[column].dataType.simpleString():
                raise ValueError(f"{self.full_name}: collection column {column} cannot be part of the key")

    @property
    def full_name(self) -> str:
        return f"{self.keyspace}.{self.name}"

    @property
    def columns(self) -> list[str]:
        return list(self.schema.names)

    @property
    def key(self) -> list[str]:
        """Primary key: partition key, then clustering columns."""
        return list(self.partition_key) + [c for c, _ in self.clustering]

    @property
    def regular(self) -> list[str]:
        key = set(self.key)
        return [c for c in self.columns if c not in key]

    def type_of(self, column: str) -> T.DataType:
        return self.schema[column].dataType

    def to_json(self) -> str:
        return json.dumps(
            {
                "keyspace": self.keyspace,
                "name": self.name,
                "schema": self.schema.jsonValue(),
                "partition_key": list(self.partition_key),
                "clustering": [list(c) for c in self.clustering],
            },
            sort_keys=True,
        )

    @staticmethod
    def from_json(text: str) -> TableSpec:
        d = json.loads(text)
        return TableSpec(
            d["keyspace"],
            d["name"],
            T.StructType.fromJson(d["schema"]),
            tuple(d["partition_key"]),
            tuple((c[0], c[1]) for c in d["clustering"]),
        )


@dataclass(frozen=True)
class LoadConf:
    """Settings of one load.

    ``ttl`` (seconds) and ``timestamp`` (microseconds) are a number for the whole load, the name
    of an input column for a per-row value, or None. A ``ttl`` of 0 or None never expires.

    ``partitioner`` chooses the token: ``hash`` (64-bit hash of the partition key), ``md5`` (top
    60 bits of its digest) or ``ordered`` (the key itself, cut at ``split_points``). Tokens fall
    into ``buckets`` equal ranges, or into the ranges that start at the ``ring`` bounds. With ``bucketed`` the files of every
    load are Spark's buckets of the partition key: loads with equally many are merged bucket by bucket, without a shuffle.
    Their keys are ascending in the files, whatever the clustering order.
    ``writers_per_bucket`` cuts every bucket further, so that several tasks write it; left out, equal ranges are cut
    into about as many slices as there are shuffle partitions, and others are not cut.

    ``count_keys`` counts the distinct keys of the written load (a scan of the key columns only);
    a load known to be free of duplicates is later read without a shuffle.

    ``index_files`` keeps for every file which partition keys it may hold and until when (``operators/files.py``; one scan of the
    tokens), so that a lookup opens few files.

    ``bytes_per_trigger`` and ``trigger_seconds`` cap the rate of a streamed load.
    """

    partitioner: str = "hash"
    buckets: int = 16
    ring: tuple[int, ...] | None = None
    split_points: tuple = field(default=())
    writers_per_bucket: int | None = None
    ttl: int | str | None = None
    timestamp: int | str | None = None
    on_bad_value: str = "fail"
    count_keys: bool = True
    index_files: bool = False
    bytes_per_trigger: int | None = None
    trigger_seconds: int = 1

    def __post_init__(self) -> None:
        if self.partitioner not in PARTITIONERS:
            raise ValueError(f"unknown partitioner {self.partitioner!r}, expected one of {', '.join(PARTITIONERS)}")
        if self.on_bad_value not in BAD_VALUE_MODES:
            raise ValueError(f"on_bad_value must be one of {', '.join(BAD_VALUE_MODES)}")
        if self.buckets < 1 or (self.writers_per_bucket is not None and self.writers_per_bucket < 1):
            raise ValueError("buckets and writers_per_bucket must be at least 1")
        if self.ring is not None:
            ring = tuple(int(b) for b in self.ring)
            if not ring or list(ring) != sorted(set(ring)):
                raise ValueError("ring bounds must be distinct and ascending")
            if self.partitioner in ("ordered", "bucketed"):
                raise ValueError(f"the {self.partitioner} partitioner takes no ring")
            object.__setattr__(self, "ring", ring)
        split_points = tuple(tuple(p) if isinstance(p, list) else p for p in self.split_points)
        if split_points and self.partitioner != "ordered":
            raise ValueError("split_points belong to the ordered partitioner")
        for point in split_points:
            for value in point if isinstance(point, tuple) else (point,):
                if not isinstance(value, (int, float, str)):
                    raise ValueError("split points are numbers or text; give dates and timestamps as text")
                if isinstance(value, float) and not math.isfinite(value):
                    raise ValueError("split points are finite numbers")
        object.__setattr__(self, "split_points", split_points)
        if isinstance(self.ttl, int) and self.ttl < 0:
            raise ValueError("ttl must not be negative")
        if self.bytes_per_trigger is not None and self.bytes_per_trigger < 1:
            raise ValueError("bytes_per_trigger must be at least 1")
        if self.trigger_seconds < 1:
            raise ValueError("trigger_seconds must be at least 1")
        if isinstance(self.ttl, str) and self.ttl == self.timestamp:
            raise ValueError("ttl and timestamp cannot come from the same column")

    @property
    def option_columns(self) -> list[str]:
        """Input columns that carry a write option, not data."""
        return [o for o in (self.ttl, self.timestamp) if isinstance(o, str)]

    @property
    def throttled(self) -> bool:
        return self.bytes_per_trigger is not None

    @staticmethod
    def from_spark(spark: SparkSession) -> LoadConf:
        """Settings from the session; keys that are not set keep their defaults."""

        def get(key: str) -> str | None:
            return spark.conf.get(CONF_PREFIX + key, None)

        def get_int(key: str) -> int | None:
            text = get(key)
            return None if text is None or int(text) == UNSET_INT else int(text)

        found = {
            "partitioner": get("partitioner"),
            "buckets": get_int("buckets"),
            "writers_per_bucket": get_int("writersPerBucket"),
            "ttl": get_int("ttl"),
            "timestamp": get_int("timestamp"),
            "on_bad_value": get("onBadValue"),
            "index_files": None if get("indexFiles") is None else get("indexFiles").lower() == "true",
            "bytes_per_trigger": get_int("bytesPerTrigger"),
            "trigger_seconds": get_int("triggerSeconds"),
        }
        return LoadConf(**{k: v for k, v in found.items() if v is not None})
