"""Merging a batch of rows into a keyed table: ignore, overwrite or increment.

Each function takes the stored rows and the new rows and returns new rows or the
merged table. Keys are matched by equi-joins. Repeats of a key inside a batch
are folded first, with map-side aggregation, so a key that holds most of the
batch costs one row per task in the shuffle and the joins see each key once.
A row with a null key has no identity and is left out, as a primary key demands.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.schemas import MergeSpec


def _pick(rows: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [name for name in rows.columns if name not in keys]
    tail = [name for name in rest if name not in order]
    picked = rows.dropna(subset=list(keys)).groupBy(*keys).agg(
        pick(F.struct(*order, *tail)).alias("row"))
    return picked.select(*[name if name in keys else F.col(f"row.{name}").alias(name)
                           for name in rows.columns])


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``; the other columns settle ties."""
    return _pick(rows, keys, order, F.min)


def last_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``; the other columns settle ties."""
    return _pick(rows, keys, order, F.max)


def deltas(rows: DataFrame, spec: MergeSpec) -> DataFrame:
    """What a batch adds to each key: summed measures and the greatest stamp."""
    return (rows.dropna(subset=list(spec.keys)).groupBy(*spec.keys)
            .agg(*[F.sum(name).alias(name) for name in spec.measures],
                 F.max(spec.stamp).alias(spec.stamp))
            .select(*rows.columns))


def unseen(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Source rows whose key the target lacks (source unique by key)."""
    keys = list(spec.keys)
    return source.join(target.select(*keys), keys, "left_anti")


def insert_ignore(target: DataFrame, source: DataFrame, spec: MergeSpec,
                  order: Sequence[str]) -> DataFrame:
    """Stored rows stay; of new keys the first row by ``order`` comes in."""
    return target.unionByName(unseen(target, first_per_key(source, spec.keys, order), spec))


def overwrite(target: DataFrame, source: DataFrame, spec: MergeSpec,
              order: Sequence[str] | None = None) -> DataFrame:
    """The last source row of a key replaces the stored one.

    Without ``order`` the source must be unique by key, as an aggregate is.
    """
    if order is not None:
        source = last_per_key(source, spec.keys, order)
    keys = list(spec.keys)
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source)


def increment(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Measures add up; the source's stamp replaces the stored one.

    With ``latest`` the greater of the two stamps stays.
    """
    keys = list(spec.keys)
    new = deltas(source, spec).select(
        *keys, *[F.col(name).alias(f"new_{name}") for name in (*spec.measures, spec.stamp)])
    joined = target.join(new, keys, "full_outer")

    def total(name: str):
        old, add = F.col(name), F.col(f"new_{name}")
        return F.coalesce(old + add, old, add).alias(name)

    values = {name: total(name) for name in spec.measures}
    stamps = (f"new_{spec.stamp}", spec.stamp)
    stamp = F.greatest(*stamps) if spec.latest else F.coalesce(*stamps)
    values[spec.stamp] = stamp.alias(spec.stamp)
    return joined.select(*[values.get(name, F.col(name)) for name in target.columns])


def merge(target: DataFrame, source: DataFrame, spec: MergeSpec,
          order: Sequence[str] | None = None) -> DataFrame:
    """The merge that ``spec.policy`` names."""
    if spec.policy == "ignore":
        return insert_ignore(target, source, spec, order or ())
    if spec.policy == "overwrite":
        return overwrite(target, source, spec, order)
    if spec.policy == "increment":
        return increment(target, source, spec)
    raise ValueError(f"unknown merge policy {spec.policy!r}")
