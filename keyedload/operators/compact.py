"""Compaction and clean-up: many loads become one, and what no reader can need is removed.

Compaction merges cells as a read does but keeps their write timestamps and expiries: a key becomes one row for each pair of
both that its newest cells have, with the columns written then. Merging is associative, so loads that come later, also ones
with older timestamps, give the rows they would have given; and reads at any time give the same rows as before.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyedload.functions.names import col
from keyedload.operators.files import write_index
from keyedload.operators.load import hot_buckets, write_attempt
from keyedload.operators.place import ASIDE, bucket_count, clustered
from keyedload.operators.resolve import Facts, by_key, cell, comparable, facts_of, from_comparable
from keyedload.sources.commits import Folder
from keyedload.sources.store import KeyedStore, LogRow, new_load_id
from keyedload.spec import ATTEMPT, BUCKET, EXPIRES, LOAD_ID, NEVER, WRITTEN, WTS, LoadConf, LoadError, TableSpec

#: Files of what is no longer needed stay that long, for reads that have begun.
GRACE_SECONDS = 86_400
# Entries of the log after which it is summed up.
CHECKPOINT_ENTRIES = 16


def compact_loads(
    store: KeyedStore,
    keyspace: str,
    table: str,
    loads: Sequence[str] | None = None,
    conf: LoadConf | None = None,
    *,
    max_rows: int | None = None,
    purge_before: int | None = None,
) -> LogRow | None:
    """Rewrite published loads as one, which takes their place in the log at once. Returns its row of the log.

    ``loads`` names them; left out, all are taken, or with ``max_rows`` those of at most so many rows. Fewer than two are left as
    they are, and None is returned. ``purge_before`` (epoch seconds) drops cells that expired earlier: an older cell of a load
    that is not compacted with them, or comes later, then shows again, and reads at an earlier time lack them.

    Files of the replaced loads stay until ``clean_up``. When one of them is replaced meanwhile by another compaction, this
    one fails and leaves nothing.
    """
    spec = store.spec(keyspace, table)
    conf = LoadConf.from_spark(store.spark) if conf is None else conf
    started, live = time.monotonic(), store.published(spec)
    unknown = set(loads or ()) - {r.load_id for r in live}
    if unknown:
        raise LoadError(f"{spec.full_name}: no published load {', '.join(sorted(unknown))}")
    chosen = [r for r in live if (loads is None or r.load_id in set(loads)) and (max_rows is None or r.rows <= max_rows)]
    if len(chosen) < 2:
        return None
    filled = [r for r in chosen if r.rows]
    facts = facts_of(spec, filled)
    rows = compacted(store.loads(spec, filled), spec, facts, purge_before)
    names = [c for c in spec.columns if c in facts.ever or c in spec.key]
    load_id, attempt = new_load_id(), uuid.uuid4().hex
    unset = replace(conf, ttl=None, timestamp=None)
    rows = clustered(rows, spec, unset)
    counted = {
        "keys": F.count(F.when(F.col("_only_pair") == 0, 1)),
        "most_versions": F.max(F.col("_only_pair")) + 1,
        "partial": F.count(F.when(F.col("_only_partial"), 1)),
        "expiring": F.count(EXPIRES),
    }
    try:
        seen = write_attempt(store, spec, rows, load_id, attempt, unset, counted)
        entry = LogRow(
            load_id=load_id,
            load_epoch=max(r.load_epoch for r in chosen),
            rows=seen["rows"],
            keys=seen["keys"],
            most_versions=seen["most_versions"],
            rejected=0,
            min_wts=seen["min_wts"],
            max_wts=seen["max_wts"],
            has_ttl=seen["expiring"] > 0,
            columns=tuple(names),
            partitioner=conf.partitioner,
            buckets=bucket_count(conf),
            ring=conf.ring,
            split_points=json.dumps(conf.split_points),
            seconds=time.monotonic() - started,
            attempt=attempt,
            whole=seen["partial"] == 0,
            replaces=tuple(r.load_id for r in chosen),
            expires=seen["expires"],
        )
        if conf.index_files and entry.rows:
            entry = replace(entry, index_blocks=write_index(store, spec, entry))
        if conf.partitioner == "bucketed":
            entry = replace(entry, hot=hot_buckets(store, spec, entry))
        store.publish(spec, entry)
    except BaseException:
        store.drop_attempt(spec, load_id, attempt)
        raise
    sum_up(store, spec)
    return entry


def compacted(rows: DataFrame, spec: TableSpec, facts: Facts, purge_before: int | None = None) -> DataFrame:
    """The mutation rows that ``rows`` come to: of every key one for each write timestamp and expiry that its marker and newest
    cells have. ``_only_pair`` numbers a key's rows from 0, ``_only_partial`` tells those that lack a written column."""
    written = [c for c in spec.regular if c in facts.ever]
    always = replace(facts, has_ttl=True)
    expires = F.coalesce(F.col(EXPIRES), F.lit(NEVER)).alias("e")
    aggs = [F.max(F.struct(F.col(WTS).alias("t"), expires)).alias("_marker")]
    aggs += [F.max(cell(c, spec, always)).alias(f"_c{i}") for i, c in enumerate(written)]
    merged = by_key(rows, spec, facts).agg(*aggs)
    cells = {c: F.col(f"_c{i}") for i, c in enumerate(written)}

    def kept(value):
        return value.isNotNull() if purge_before is None else F.coalesce(value["e"] > F.lit(purge_before), F.lit(False))

    pairs = [F.when(kept(v), F.struct(v["t"].alias("t"), v["e"].alias("e"))) for v in (F.col("_marker"), *cells.values())]
    pairs = F.filter(F.array_distinct(F.array(*pairs)), lambda p: p.isNotNull())
    rows = merged.select("*", F.posexplode(pairs).alias("_only_pair", "_p"))
    here = {c: F.coalesce(kept(v) & (v["t"] == F.col("_p.t")) & (v["e"] == F.col("_p.e")), F.lit(False)) for c, v in cells.items()}
    values = [F.when(here[c], from_comparable(v["v"], spec.type_of(c))).cast(spec.type_of(c)).alias(c) for c, v in cells.items()]
    names = F.filter(F.array(*[F.lit(c) for c in spec.key], *[F.when(here[c], F.lit(c)) for c in written]), lambda n: n.isNotNull())
    partial = F.size(names) < len(spec.key) + len(written)
    whole = len(written) == len(spec.regular)
    return rows.select(
        *[col(c) for c in spec.key],
        *values,
        F.col("_p.t").alias(WTS),
        F.when(F.col("_p.e") < NEVER, F.col("_p.e")).alias(EXPIRES),
        (F.when(partial, names) if whole else names).alias(WRITTEN),
        "_only_pair",
        partial.alias("_only_partial"),
    )


def sum_up(store: KeyedStore, spec: TableSpec, least: int = CHECKPOINT_ENTRIES) -> bool:
    """Writes a checkpoint of the log when so many entries have come since the last."""
    commits = store.commits(spec)
    found, last = commits.read()
    if found is None or commits.entries_behind() < least:
        return False
    commits.write_checkpoint(store.summed(found), last)
    return True


def clean_up(store: KeyedStore, keyspace: str, table: str, grace_seconds: int = GRACE_SECONDS) -> list[str]:
    """Remove load directories that no reader can need, and return their paths below the table's.

    These are of failed attempts and loads never published, once nothing in them has changed for ``grace_seconds``, and of
    loads replaced longer ago than that. The grace must be longer than the longest load and the longest read. An attempt is
    first given up in the log, so it cannot be published any more, and then removed. Old entries of the log that a checkpoint
    sums up go too. Rows that a replaced load has set aside stay.
    """
    spec = store.spec(keyspace, table)
    before = int((time.time() - grace_seconds) * 1000)
    folder = Folder(store.spark, store.table_path(keyspace, table))
    while True:
        entries, last = store.entries(spec)
        listed = store.spark.createDataFrame(_listed(folder), f"{LOAD_ID} string, attempt string, name string")
        now = store.summed(entries).where(f"{LOAD_ID} IS NOT NULL")
        known = now.select(
            LOAD_ID, F.coalesce("attempt", F.lit("")).alias("attempt"), "kind", "rejected", F.unix_millis("published_at").alias("at")
        )
        # Live loads fall out of the join; what is left is small when clean-up is regular.
        rest = listed.join(known.where("kind = 'load'"), [LOAD_ID, "attempt"], "left_anti")
        rest = rest.join(known.where("kind = 'gone'"), [LOAD_ID, "attempt"], "left").collect()
        gone = [r for r in rest if r.kind == "gone" and r["at"] < before]
        given_up = [r for r in rest if r.kind is None and folder.last_change(r.name) < before]
        if not given_up:
            break
        if store.commits(spec).add(last + 1, json.dumps({"kind": "clean", "abandoned": [r.attempt or "" for r in given_up]})):
            break
    removed = []
    for r in gone + given_up:
        if r.rejected:
            inside = Folder(store.spark, f"{folder.path}/{r.name}")
            # Files in Spark's buckets hold both.
            buckets = [n for n in inside.list().names if n.startswith(f"{BUCKET}=") and n != f"{BUCKET}={ASIDE}"]
            removed += [f"{r.name}/{n}" for n in buckets if inside.remove(n)]
        elif folder.remove(r.name):
            removed.append(r.name)
            if r.attempt:
                folder.remove_if_empty(r.name.rsplit("/", 1)[0])
    sum_up(store, spec)
    store.commits(spec).remove_before(before)
    return sorted(removed)


def _listed(folder: Folder) -> list[tuple[str, str, str]]:
    """Load, attempt and path of every load directory; loads of the earlier layout have no attempts."""
    out = []
    for root in ("data", "buckets"):
        for name in Folder(folder.spark, f"{folder.path}/{root}").list().names:
            if name.startswith(f"{LOAD_ID}="):
                path = f"{root}/{name}"
                inside = Folder(folder.spark, f"{folder.path}/{path}").list().names
                attempts = [n for n in inside if n.startswith(f"{ATTEMPT}=")]
                load_id = name.removeprefix(f"{LOAD_ID}=")
                out += [(load_id, n.removeprefix(f"{ATTEMPT}="), f"{path}/{n}") for n in attempts]
                if len(attempts) < len(inside):
                    out.append((load_id, "", path))
    return out
