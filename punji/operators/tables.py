"""Upserts, deletes and edits as batch operations on keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the last by ``order``; ties by the whole row, so the choice doesn't depend on the partitioning.

    A maximum of structs: partial aggregation before the shuffle, so many versions of one key don't meet in one task.
    """
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max(F.struct(F.struct(*order).alias("o"), F.struct(*rest).alias("r"))).alias("b"))
    return best.select(*(F.col(k) if k in keys else F.col(f"b.r.{k}").alias(k) for k in rows.columns))


def upsert(base: DataFrame, batch: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """``base`` with the rows of ``batch`` in place of those with the same keys.

    Of several rows of one key in the batch the last by ``order`` counts, without an order the greatest.
    """
    one = latest(batch, keys, order or [F.lit(0)])
    return base.join(one.select(*keys), keys, "left_anti").unionByName(one, allowMissingColumns=True)


def delete(base: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` without the rows whose keys are in ``gone``; used for cascades too."""
    return base.join(gone.select(*keys).distinct(), keys, "left_anti")


EDITABLE = ("title", "series", "body", "authors_json", "author_sources_json", "continuation_of", "confidence", "review_flags_json")


def apply_edits(base: DataFrame, edits: DataFrame, keys: list[str], allowed: tuple[str, ...] = EDITABLE) -> DataFrame:
    """``base`` with the non-null values of ``edits`` (one row a key) in the allowed columns; others are ignored."""
    used = [c for c in edits.columns if c in allowed and c in base.columns]
    if not used:
        return base
    named = edits.select(*keys, *(F.col(c).alias(f"__{c}") for c in used))
    return base.join(named, keys, "left").select(*(F.coalesce(f"__{c}", c).alias(c) if c in used else F.col(c) for c in base.columns))
