"""Keyed bulk loading on Spark: load DataFrames into keyed tables and read them back merged."""

from keyedload.operators.compact import clean_up, compact_loads
from keyedload.operators.load import bulk_load, publish_load, read_rejects
from keyedload.operators.resolve import lookup, read_table
from keyedload.operators.split import ordered_split_points
from keyedload.sources.inputs import from_rdd, read_csv
from keyedload.sources.store import KeyedStore, LogRow, scratch_root
from keyedload.spec import AlreadyPublished, ContractError, LoadConf, LoadError, TableNotFound, TableSpec

__all__ = [
    "AlreadyPublished",
    "ContractError",
    "KeyedStore",
    "LoadConf",
    "LoadError",
    "LogRow",
    "TableNotFound",
    "TableSpec",
    "bulk_load",
    "clean_up",
    "compact_loads",
    "from_rdd",
    "lookup",
    "ordered_split_points",
    "publish_load",
    "read_csv",
    "read_rejects",
    "read_table",
    "scratch_root",
]
