"""Key, reference and null checks that a database would enforce."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FACT_REFERENCES
from .skew import hot_keys, salted_join


class IntegrityError(ValueError):
    """A batch breaks a key, reference or not-null rule."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, nulls) for each listed column, from one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns])
    return counted.select(F.inline(pairs))


def orphans(
    facts: DataFrame,
    dims: dict[str, DataFrame],
    references: dict[str, tuple[str, str]] = FACT_REFERENCES,
) -> DataFrame:
    """(fk, key, rows): referenced keys that the dimension lacks; null references pass.

    One scan of the facts counts the keys of all references at once, so only distinct
    keys are shuffled and a hot key costs no more than a rare one.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("fk"), F.col(c).cast("string").alias("key")) for c in references]
    )
    used = (
        facts.select(F.inline(pairs))
        .where(F.col("key").isNotNull())
        .groupBy("fk", "key")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = None
    for fk, (table, key) in references.items():
        part = dims[table].select(F.lit(fk).alias("fk"), F.col(key).cast("string").alias("key"))
        known = part if known is None else known.unionByName(part)
    return used.join(known, ["fk", "key"], "left_anti")


def drop_orphans(
    facts: DataFrame, bad: DataFrame, references: dict[str, tuple[str, str]] = FACT_REFERENCES
) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected) facts: rejected rows hold at least one of the `orphans` found."""
    marked, rejected = facts, F.lit(False)
    for fk in references:
        key = F.col("key").cast(facts.schema[fk].dataType).alias(fk)
        lost = bad.where(F.col("fk") == fk).select(key, F.lit(True).alias(f"_bad_{fk}"))
        marked = salted_join(marked, lost, [fk], hot_keys(facts, [fk]), "left")
        rejected = rejected | F.col(f"_bad_{fk}").isNotNull()
    return marked.where(~rejected).select(*facts.columns), marked.where(rejected).select(*facts.columns)


def require_unique(df: DataFrame, keys: list[str], table: str) -> None:
    found = duplicate_keys(df, keys).limit(1).collect()
    if found:
        raise IntegrityError(f"{table}: duplicate key {found[0].asDict()}")


def require_not_null(df: DataFrame, columns: list[str], table: str) -> None:
    found = null_counts(df, columns).where("nulls > 0").collect()
    if found:
        raise IntegrityError(f"{table}: nulls in {[(r['column_name'], r['nulls']) for r in found]}")


def require_keys(df: DataFrame, keys: list[str], not_null: list[str], table: str) -> None:
    """Both rules in one pass; the separate checks only run to name what is wrong."""
    nulls = [F.count_if(F.col(c).isNull()) for c in not_null]
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), sum(nulls[1:], nulls[0]).alias("nulls")
    )
    worst = per_key.agg(F.max("rows").alias("rows"), F.sum("nulls").alias("nulls")).first()
    if worst["nulls"]:
        require_not_null(df, not_null, table)
    if (worst["rows"] or 0) > 1:
        require_unique(df, keys, table)


def require_references(bad: DataFrame, table: str = "fact_delay") -> None:
    """Fail when `orphans` found any."""
    found = bad.orderBy("fk", "key").limit(5).collect()
    if found:
        raise IntegrityError(f"{table}: unknown references {[(r['fk'], r['key']) for r in found]}")
