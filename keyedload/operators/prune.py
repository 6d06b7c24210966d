"""Narrow mutation rows to one partition key, with the placement each load was written with."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyedload.functions.convert import to_millis
from keyedload.functions.names import col
from keyedload.operators.files import Place, file_token
from keyedload.operators.place import SLICE, with_placement
from keyedload.sources.store import LogRow
from keyedload.spec import BUCKET, LOAD_ID, TOKEN, LoadConf, TableSpec


def places_of(
    spark: SparkSession, spec: TableSpec, loads: Sequence[LogRow], key: Sequence
) -> tuple[dict[str, Column], dict[str, Place]]:
    """The values of a partition key as they are stored, and where it lies under each load: one small evaluation for all."""
    if len(key) != len(spec.partition_key):
        raise ValueError(f"{spec.full_name}: the partition key has {len(spec.partition_key)} columns")
    # As stored values are: of the column's type, timestamps in milliseconds.
    types = {c: spec.type_of(c) for c in spec.partition_key}
    wanted = {c: to_millis(F.lit(v).cast(types[c]), types[c]) for c, v in zip(types, key)}
    by_placement: dict[LoadConf, list[str]] = {}
    for r in loads:
        conf = LoadConf(
            partitioner=r.partitioner, buckets=r.buckets, ring=r.ring, split_points=json.loads(r.split_points)
        )
        by_placement.setdefault(conf, []).append(r.load_id)
    if not by_placement:
        return wanted, {}
    one = spark.range(1, numPartitions=1).select(*[v.alias(c) for c, v in wanted.items()])
    one = one.select("*", *[F.lit(None).cast(spec.type_of(c)).alias(c) for c, _ in spec.clustering])
    for i, conf in enumerate(by_placement):
        one = with_placement(one, spec, conf).drop(SLICE).withColumn(f"_known{i}", file_token(spec, conf.partitioner))
        one = one.withColumnsRenamed({BUCKET: f"{BUCKET}{i}", TOKEN: f"{TOKEN}{i}"})
    found = one.first().asDict()
    places = {}
    for i, ids in enumerate(by_placement.values()):
        place = Place(found[f"{BUCKET}{i}"], found.get(f"{TOKEN}{i}"), found[f"_known{i}"])
        places.update(dict.fromkeys(ids, place))
    return wanted, places


def only_partition(rows: DataFrame, wanted: dict[str, Column], places: dict[str, Place], loads: Sequence[LogRow]) -> DataFrame:
    for c, v in wanted.items():
        rows = rows.where(col(c) == v)
    at: dict[Place, list[str]] = {}
    for r in loads:
        at.setdefault(places[r.load_id], []).append(r.load_id)
    narrowed: Column | None = None
    for place, ids in at.items():
        here = F.col(BUCKET) == F.lit(place.bucket)
        if place.token is not None:
            here = here & (F.col(TOKEN) == F.lit(place.token))
        if len(at) > 1:
            here = F.col(LOAD_ID).isin(ids) & here
        narrowed = here if narrowed is None else narrowed | here
    return rows if narrowed is None else rows.where(narrowed)
