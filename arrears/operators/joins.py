"""Join helpers (J1-J16) that need more than a plain ``df.join``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Partitions that rows with a NULL key spread over.
_SALTS = 64


def left_lookup(df: DataFrame, dim: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left join of lookup columns where the fact key may be NULL.

    Rows with a NULL key can never match, but a shuffle join would still
    send all of them to the one partition NULL hashes to -- the hottest
    "key" of a mostly-unmatched lookup.  They get a salt that no row of the
    lookup has, which spreads them over the partitions; the input is read
    once.  The lookup's own salt, always 0, is computed from its key: Spark
    would take a literal out of the join's key, and the left salt with it."""
    keys = [key] if isinstance(key, str) else list(key)
    has_key = None
    for k in keys:
        c = F.col(k).isNotNull()
        has_key = c if has_key is None else has_key & c
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    salt = F.when(has_key, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(*plain), F.lit(_SALTS)).cast("int"))
    left = df.withColumn("_salt", salt)
    right = dim.withColumn("_salt", F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")).withColumnsRenamed({k: f"_dim_{k}" for k in keys})
    zero = {f.name: F.lit("").cast(f.dataType) if isinstance(f.dataType, T.StringType) else F.lit(0).cast("int").cast(f.dataType)
            for f in df.schema.fields if f.name in keys and isinstance(f.dataType, (T.StringType, T.NumericType))}
    on = left["_salt"] == right["_salt"]
    for k in keys:
        on = on & ((F.coalesce(left[k], zero[k]) if k in zero else left[k]) == right[f"_dim_{k}"])
    extra = [c for c in dim.columns if c not in keys]
    return left.join(right, on, "left").select(*(left[c] for c in df.columns), *(right[c] for c in extra))


def lookup_default(df: DataFrame, dim: DataFrame, key: str | Sequence[str], col: str,
                   default, alias: str | None = None) -> DataFrame:
    """Left join a lookup column, with a default for a miss (``isnull``)."""
    keys = [key] if isinstance(key, str) else list(key)
    d = dim.select(*keys, F.col(col).alias("_lk"))
    out = left_lookup(df, d, keys)
    return out.withColumn(alias or col, F.coalesce(F.col("_lk"), F.lit(default))).drop("_lk")


def key_set(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Distinct key list for the right side of a semi / anti join.

    The dedup is a partial aggregate (map-side), and its shuffle on the
    keys is the one the join needs anyway; it bounds the rows a sort-merge
    semi / anti join buffers per key to one, so a key repeated across a
    third of the input never piles up in one task."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.select(*keys).distinct()


def reduce_by_keys(df: DataFrame, keys_df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keep the rows of a big table whose key is in a key list.

    ``keys_df`` is a filtered scan, not its distinct keys: only then does Spark
    build a runtime bloom filter of them and drop most of the big table's rows
    before its shuffle.  A sort-merge semi join without a condition buffers one
    row per key, so keys that repeat cost no memory.  ``session.REDUCE_CONF``
    has the settings."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(keys_df.select(*keys), keys, "left_semi")


def semi_by_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """J6 / J7 for wide rows and an integer key: the rows whose key is in a list
    of ids, without a shuffle of the rows.

    The list becomes a table with a row for each 64 consecutive ids, a bit an
    id, which is broadcast: a few tens of MB for some ten million ids of an
    identity column."""
    k = F.col(key).cast("bigint")
    parts = {"_word": F.shiftright(k, 6), "_bit": k.bitwiseAND(F.lit(63)).cast("int")}
    words = (ids.select(key).where(F.col(key).isNotNull()).withColumns(parts)
             .groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_ids")))
    return df.withColumns(parts).join(F.broadcast(words), "_word").where(F.getbit("_ids", F.col("_bit")) == 1).select(*df.columns)


def in_snapshot(facts: DataFrame, base360: DataFrame, day: str) -> DataFrame:
    """J3 without columns of the snapshot: the facts whose debtor and contract
    are in the snapshot of their ``day``.

    Over many days the history has a row for each day of a contract.  These are
    first combined, a bit a day, into a row for each 64 days (a partial
    aggregate), so not the whole history is shuffled and sorted."""
    def parts(c: str) -> dict[str, Column]:
        d = F.unix_date(c)
        return {"_word": F.shiftright(d, 6), "_bit": d.bitwiseAND(F.lit(63))}

    keys = ["id_devedor", "id_titulo", "_word"]
    held = (base360.select("id_devedor", "id_titulo", "data").withColumns(parts("data"))
            .groupBy(*keys).agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_days")))
    return facts.withColumns(parts(day)).join(held, keys).where(F.getbit("_days", F.col("_bit")) == 1).select(*facts.columns)


def attach_snapshot(facts: DataFrame, base: DataFrame, keys: Sequence[str],
                    fact_ts_col: str, base_date_col: str = "data",
                    base_cols: Sequence[str] = ()) -> DataFrame:
    """Inner join facts to the daily snapshot on the keys plus the
    calendar day of a fact timestamp."""
    b = base.select(*keys, F.col(base_date_col).alias("_snap_day"), *base_cols)
    f = facts.withColumn("_snap_day", F.to_date(F.col(fact_ts_col)))
    return f.join(b, list(keys) + ["_snap_day"], "inner").drop("_snap_day")


def semi_where(df: DataFrame, other: DataFrame, key: str | Sequence[str], cond: Column) -> DataFrame:
    """Semi join against the rows of ``other`` that satisfy an OR
    condition; the condition is applied to ``other`` first."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(key_set(other.filter(cond), keys), keys, "left_semi")


def snapshot_id(*cols) -> Column:
    """Stable surrogate key of a snapshot row (64-bit hash of its
    natural key) -- identical on every run and executor, unlike
    ``monotonically_increasing_id``."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])
