"""Column contract between an input DataFrame and a table. Names only, no Spark job.

Names are compared as exact strings; Spark itself would ignore case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from keyedload.spec import ContractError, LoadConf, TableSpec


def selected_columns(spec: TableSpec, columns: Sequence | None, conf: LoadConf) -> list[str]:
    """Data columns of a load: all columns of the table, or the unique names asked for.

    Columns that carry a write option are not data. An entry may be a ``(name, "replace")`` pair;
    a collection is always replaced whole, so any other behaviour is refused.
    """
    if columns is None:
        names = spec.columns
        behaviours = []
    else:
        pairs = [(c, "replace") if isinstance(c, str) else tuple(c) for c in columns]
        names = list(dict.fromkeys(name for name, _ in pairs))
        behaviours = [b for _, b in pairs if b != "replace"]
    check_known(spec, names)
    check_key_selected(spec, names)
    if behaviours:
        raise ContractError(
            f"{spec.full_name}: collection columns can only be replaced as a whole, not {', '.join(sorted(set(behaviours)))}"
        )
    options = set(conf.option_columns)
    if options & set(spec.key):
        raise ContractError(f"{spec.full_name}: a key column cannot carry a write option")
    return [c for c in names if c not in options]


def check_known(spec: TableSpec, names: Sequence[str]) -> None:
    known = set(spec.columns)
    unknown = [c for c in names if c not in known]
    if unknown:
        raise ContractError(f"{spec.full_name} has no column {', '.join(unknown)}")


def check_key_selected(spec: TableSpec, names: Sequence[str]) -> None:
    missing = [c for c in spec.key if c not in set(names)]
    if missing:
        raise ContractError(f"{spec.full_name}: primary key column {', '.join(missing)} missing from the load")


def check_input(df: DataFrame, spec: TableSpec, names: Sequence[str], conf: LoadConf, strict: bool) -> None:
    """The input must have the selected and option columns; in strict mode nothing else."""
    have = df.columns
    if len(set(have)) != len(have):
        raise ContractError(f"{spec.full_name}: duplicate input columns")
    wanted = list(names) + conf.option_columns
    missing = [c for c in wanted if c not in set(have)]
    if missing:
        raise ContractError(f"{spec.full_name}: input lacks column {', '.join(missing)}")
    if strict:
        extra = [c for c in have if c not in set(wanted)]
        if extra:
            raise ContractError(
                f"{spec.full_name}: input has columns the table does not take: {', '.join(extra)}; "
                "name the columns to load to discard the others"
            )


def bind_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename the input columns to ``names`` in order."""
    if len(df.columns) != len(names):
        raise ContractError(f"expected {len(names)} columns by position, input has {len(df.columns)}")
    return df.toDF(*names)
