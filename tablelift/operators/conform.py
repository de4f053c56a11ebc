"""Conform: cast every column of a scan to the declared type system in one projection.

``conform`` is a single ``select`` of column expressions (whole-stage code-generated, no shuffle,
no UDF). Row count and per-column reject counts (source not NULL, output NULL or another value, see
``casts.loses``) are gathered by ``DataFrame.observe`` while the data flows to the sink, so there is
no second scan.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions import casts
from tablelift.functions.columns import col
from tablelift.functions.types import declared_types, target_type_name

REJECT_PREFIX = "rejects__"


@dataclass
class Conformed:
    df: DataFrame
    observation: Observation | None
    targets: dict[str, str]
    reject_columns: list[str] = field(default_factory=list)

    def metrics(self) -> dict:
        """Rows and rejects; only valid after an action ran on ``df``."""
        if self.observation is None:
            return {}
        return dict(self.observation.get)

    def rows(self) -> int | None:
        m = self.metrics()
        return m.get("rows")

    def rejects(self) -> dict[str, int]:
        m = self.metrics()
        return {k[len(REJECT_PREFIX):]: v for k, v in m.items() if k.startswith(REJECT_PREFIX) and v}


def check_arity(df: DataFrame, declared: dict[str, str]) -> None:
    """Declared columns and scanned columns must agree before anything is read (E004)."""
    cols = df.columns
    if len(cols) != len(declared):
        raise ValueError(f"E004 column count mismatch: declared {len(declared)}, scanned {len(cols)}")
    missing = [c for c in declared if c not in cols]
    if missing:
        raise ValueError(f"E004 declared columns not in scan: {missing}")


def conform_columns(
    df: DataFrame, declared: dict[str, str], dialect: str | None = None, narrow: str = "null"
) -> list[tuple[str, Column, T.DataType, str]]:
    src_types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name in df.columns:
        target = target_type_name(declared[name], dialect)
        expr = casts.convert(col(name), src_types[name], target, narrow)
        out.append((name, expr, src_types[name], target))
    return out


def conform(
    df: DataFrame,
    declared: dict[str, str] | None = None,
    dialect: str | None = None,
    narrow: str = "null",
    observe: bool = True,
) -> Conformed:
    """Cast ``df`` to the targets of its declared SQL types.

    ``declared`` maps column -> declared SQL type name (from the source catalog); by default the
    names are derived from the Spark schema (file-backed sources).
    """
    if narrow not in ("null", "wrap"):
        raise ValueError("narrow must be 'null' or 'wrap'")
    if declared is None:
        declared = declared_types(df.schema)
    check_arity(df, declared)
    cols = conform_columns(df, declared, dialect, narrow)
    targets = {name: target for name, _, _, target in cols}
    if not observe:
        return Conformed(df.select(*[e.alias(n) for n, e, _, _ in cols]), None, targets)

    reject_cols = [n for n, _, src, t in cols if casts.can_reject(src, t, narrow)]
    taken = set(df.columns)
    tag = "__tablelift_src"
    while any(c.startswith(tag) for c in taken):  # never shadow a real column
        tag = "_" + tag
    src_alias = {n: f"{tag}_{i}" for i, n in enumerate(reject_cols)}
    staged = df.select(
        *[col(n).alias(src_alias[n]) for n in reject_cols],
        *[e.alias(n) for n, e, _, _ in cols],
    )
    obs = Observation(f"conform_{uuid.uuid4().hex[:10]}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    for n, _, src, target in cols:
        if n in src_alias:
            lost = casts.loses(F.col(src_alias[n]), src, col(n), target)
            gone = F.col(src_alias[n]).isNotNull() & col(n).isNull()
            metrics.append(F.count_if(gone if lost is None else gone | lost).alias(REJECT_PREFIX + n))
    observed = staged.observe(obs, *metrics).select(*[col(n) for n, _, _, _ in cols])
    return Conformed(observed, obs, targets, reject_cols)
