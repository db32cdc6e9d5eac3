"""Changes to the documents of an index: upsert, delete, and what they count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(existing: DataFrame, incoming: DataFrame, key: str = "key", order: str | None = None) -> DataFrame:
    """``existing`` with the rows of ``incoming`` laid over it by key: of each key the last row, by ``order`` within ``incoming``.

    Rows of ``incoming`` with a null key are skipped. One aggregation by key, combined on the map side, so a key delivered
    any number of times is no burden; rows of ``existing`` repeat no key.
    """
    cols = existing.columns
    place = F.struct(F.lit(1).alias("g"), (F.col(order) if order else F.monotonically_increasing_id()).cast("string" if order is None else incoming.schema[order].dataType).alias("o"))
    if order is None:
        place = F.struct(F.lit(1).alias("g"), F.monotonically_increasing_id().alias("o"))
        zero = F.struct(F.lit(0).alias("g"), F.lit(0).cast("bigint").alias("o"))
    else:
        zero = F.struct(F.lit(0).alias("g"), F.lit(None).cast(incoming.schema[order].dataType).alias("o"))
    row = F.struct(*(F.col(f"`{c}`") for c in cols))
    both = existing.select(F.col(key).alias("__k"), zero.alias("__p"), row.alias("__r")).unionByName(incoming.filter(F.col(key).isNotNull()).select(F.col(key).alias("__k"), place.alias("__p"), row.alias("__r")))
    return both.groupBy("__k").agg(F.max_by("__r", "__p").alias("__r")).select("__r.*")


def upsert_counts(existing: DataFrame, incoming: DataFrame, key: str = "key") -> DataFrame:
    """deleted, inserted, updated: keys that are new count as inserted; all other rows of ``incoming``, repeats and null keys included, as updated."""
    new = incoming.filter(F.col(key).isNotNull()).select(key).distinct().join(existing.select(key).distinct(), key, "left_anti")
    rows = incoming.agg(F.count("*")).scalar()
    return new.agg(F.count("*").alias("inserted")).select(F.lit(0).cast("bigint").alias("deleted"), "inserted", (rows - F.col("inserted")).alias("updated"))


def delete_keys(existing: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """``existing`` without the rows whose key is in ``keys``; rows with a null key stay."""
    return existing.join(keys.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")
