"""Change detection and table maintenance.

Every function returns the rows to write or the new table state as a lazy
``DataFrame``; writing it (staged overwrite, append) is the caller's job
(see ``arrears.sources.io``).  All joins are equi joins on the table key,
so they plan as shuffle (or broadcast) hash / sort-merge joins whose skew
AQE can split; no condition is evaluated over pairs inside a key group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.functions.derive import NULL_DATE_SENTINEL

ACTION = "acao"          # I inserted, U updated, N kept as it was
INSERTED, UPDATED, KEPT = "I", "U", "N"


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def sentinel_for(dtype: T.DataType) -> Column:
    """Value standing for NULL in ``isnull(x, sentinel)`` compares."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.lit(NULL_DATE_SENTINEL + " 00:00:00").cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.to_date(F.lit(NULL_DATE_SENTINEL))
    if isinstance(dtype, T.StringType):
        return F.lit("")
    return F.lit(0).cast(dtype)


def _sentinel_cols(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    return df.withColumns({f"{prefix}{c}": F.coalesce(F.col(c), sentinel_for(types[c])) for c in cols})


def drop_unchanged(staged: DataFrame, target: DataFrame, keys, version_cols: Sequence[str],
                   null_safe: bool = False) -> DataFrame:
    """Drop staged rows the target already holds with the same
    key and version.  By default NULL compares equal to the sentinel date
    (so NULL and 1900-01-01 are the same version, D1); ``null_safe=True``
    is the truly NULL-safe form (C2)."""
    keys = _keys(keys)
    if null_safe:
        # target columns renamed so the condition never refers to a column
        # both sides share (staged and target may come from one lineage)
        t = target.select(*[F.col(k).alias(f"_tk_{k}") for k in keys],
                          *[F.col(v).alias(f"_t_{v}") for v in version_cols])
        cond = None
        for k in keys:
            c = F.col(k) == F.col(f"_tk_{k}")
            cond = c if cond is None else cond & c
        for v in version_cols:
            cond = cond & F.col(v).eqNullSafe(F.col(f"_t_{v}"))
        return staged.join(t, cond, "left_anti")
    s = _sentinel_cols(staged, version_cols, "_v_")
    t = _sentinel_cols(target.select(*keys, *version_cols), version_cols, "_v_").select(
        *keys, *[f"_v_{v}" for v in version_cols])
    on = keys + [f"_v_{v}" for v in version_cols]
    return s.join(t, on, "left_anti").drop(*[f"_v_{v}" for v in version_cols])


def insert_absent(target: DataFrame, staged: DataFrame, keys) -> DataFrame:
    """Staged rows whose key the target does not hold.  Duplicates
    inside one batch all go in (D22)."""
    keys = _keys(keys)
    return staged.join(target.select(*keys), keys, "left_anti")


def append_absent(target: DataFrame, staged: DataFrame, keys, mark: bool = False) -> DataFrame:
    """New target state after K3: target plus the absent staged rows."""
    return append(target, insert_absent(target, staged, keys).select(*target.columns), mark)


def append(target: DataFrame, new: DataFrame, mark: bool = False) -> DataFrame:
    """New target state: target plus new rows."""
    if mark:
        return (target.withColumn(ACTION, F.lit(KEPT))
                .unionByName(new.withColumn(ACTION, F.lit(INSERTED))))
    return target.unionByName(new)


def one_per_key(df: DataFrame, keys, cols: Sequence[str]) -> DataFrame:
    """One deterministic row per key (largest value tuple) by a partial
    aggregate -- no key group is ever collected in one task."""
    keys = _keys(keys)
    cols = [c for c in cols if c not in keys]
    if not cols:
        return df.select(*keys).distinct()
    return (df.groupBy(*keys).agg(F.max(F.struct(*cols)).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in cols]))


def require_unique(staged: DataFrame, keys) -> None:
    """Fail when two different staged rows have the same key, as a primary
    key would: which of them to keep is not the load's to choose.  A count
    over the keys of the (small, staged) extract; equal rows are one row."""
    keys = _keys(keys)
    twice = staged.distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    bad = twice.select(*keys).first()
    if bad is not None:
        raise ValueError(f"different rows for key {tuple(bad)}")


def _require_columns(target: DataFrame, cols: Sequence[str]) -> None:
    missing = [c for c in cols if c not in target.columns]
    if missing:
        raise ValueError(f"the target has no column {', '.join(missing)}")


def _apply(target: DataFrame, staged: DataFrame, keys, set_cols: Sequence[str],
           when: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None,
           per_col: Callable[[str, Column, Column], Column] | None,
           mark: bool) -> DataFrame:
    keys = _keys(keys)
    s_cols = [c for c in staged.columns if c not in keys]
    s = one_per_key(staged, keys, s_cols)
    s = s.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in s_cols], F.lit(True).alias("_hit"))
    j = target.join(s, keys, "left")

    def old(c):
        return F.col(c)

    def new(c):
        return F.col(f"_n_{c}")

    change = F.col("_hit").isNotNull()
    if when is not None:
        change = change & F.coalesce(when(old, new), F.lit(False))
    out = []
    for c in target.columns:
        if c in set_cols:
            v = per_col(c, old(c), new(c)) if per_col else new(c)
            out.append(F.when(change, v).otherwise(old(c)).alias(c))
        else:
            out.append(old(c))
    if mark:
        out.append(F.when(change, F.lit(UPDATED)).otherwise(F.lit(KEPT)).alias(ACTION))
    return j.select(*out)


def update_matched(target: DataFrame, staged: DataFrame, keys, set_cols: Sequence[str],
                   when=None, mark: bool = False) -> DataFrame:
    """New target state where matched rows take the staged values
    of ``set_cols`` when ``when(old, new)`` holds (all matched rows when
    ``when`` is None).  ``old(c)`` / ``new(c)`` give the two sides of a
    column."""
    return _apply(target, staged, keys, set_cols, when, None, mark)


def fill_null_once(target: DataFrame, staged: DataFrame, keys, cols: Sequence[str],
                   mark: bool = False, trigger: str | None = None) -> DataFrame:
    """Where the target's ``trigger`` column (the first of ``cols``) is
    NULL and the staged one is not, take all of ``cols``; a row whose
    trigger is set keeps them all."""
    trigger = trigger or cols[0]
    _require_columns(target, [trigger, *cols])
    return _apply(target, staged, keys, cols, lambda old, new: old(trigger).isNull() & new(trigger).isNotNull(), None, mark)


def update_unless_equal(target: DataFrame, staged: DataFrame, keys, version_col: str,
                        set_cols: Sequence[str], mark: bool = False) -> DataFrame:
    """Update unless the versions are equal and both non-NULL
    (NULL = NULL counts as different)."""
    return _apply(target, staged, keys, set_cols,
                  lambda old, new: ~F.coalesce(old(version_col) == new(version_col), F.lit(False)),
                  None, mark)


def upsert(target: DataFrame, staged: DataFrame, keys, version_cols: Sequence[str],
           set_cols: Sequence[str], mark: bool = False, null_safe: bool = False,
           fill_only: bool = False) -> DataFrame:
    """C3 = C1 + A7 + K3 + K4 in one full outer join on the key.

    Staged rows are reduced to one per key (a partial aggregate, which also
    covers A7), then joined once with the target: keys only in the staged
    rows are inserted whole; keys in both take the staged ``set_cols`` when
    a version differs (NULL = sentinel, or NULL-safe with ``null_safe``,
    C2); everything else is kept.  ``fill_only`` turns the update into
    C5 (only where the first set column is NULL in the target and not in
    the staged row).  The staged side is shuffled once (its
    aggregate's partitioning serves the join) and the target once.  Source
    keys are unique in practice; if not, the largest row per key is used.
    """
    keys = _keys(keys)
    s_cols = [c for c in target.columns if c not in keys]
    if list(set_cols) == ["*"]:
        set_cols = s_cols
    _require_columns(target, [*set_cols, *version_cols])
    s = one_per_key(staged.select(*target.columns), keys, s_cols)
    s = s.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in s_cols], F.lit(True).alias("_hit"))
    t = target.withColumn("_old", F.lit(True))
    j = t.join(s, keys, "full_outer")
    types = dict((f.name, f.dataType) for f in target.schema.fields)
    changed = None
    for v in version_cols:
        if null_safe:
            d = ~F.col(v).eqNullSafe(F.col(f"_n_{v}"))
        else:
            sent = sentinel_for(types[v])
            d = F.coalesce(F.col(v), sent) != F.coalesce(F.col(f"_n_{v}"), sent)
        changed = d if changed is None else (changed | d)
    is_new = F.col("_old").isNull()
    is_upd = F.col("_old").isNotNull() & F.col("_hit").isNotNull() & changed
    if fill_only:
        # C1 + C5: a changed row fills only while the trigger is still NULL
        is_upd = is_upd & F.col(set_cols[0]).isNull() & F.col(f"_n_{set_cols[0]}").isNotNull()
    out = list(keys)
    for c in s_cols:
        if c in set_cols:
            out.append(F.when(is_new | is_upd, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(is_new, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c))
    if mark:
        out.append(F.when(is_new, F.lit(INSERTED)).when(is_upd, F.lit(UPDATED))
                   .otherwise(F.lit(KEPT)).alias(ACTION))
    return j.select(*out)


def flag_missing(target: DataFrame, snapshot: DataFrame, keys, flag_col: str, value,
                 scope: Column | None = None, mark: bool = False) -> DataFrame:
    """Target rows in ``scope`` with no match in the new snapshot
    and no flag yet get ``flag_col = value``."""
    keys = _keys(keys)
    present = snapshot.select(*keys).distinct().withColumn("_present", F.lit(True))
    j = target.join(present, keys, "left")
    cond = F.col("_present").isNull() & F.col(flag_col).isNull()
    if scope is not None:
        cond = cond & F.coalesce(scope, F.lit(False))
    ftype = dict((f.name, f.dataType) for f in target.schema.fields)[flag_col]
    cols = [F.when(cond, F.lit(value).cast(ftype)).otherwise(F.col(flag_col)).alias(flag_col)
            if c == flag_col else F.col(c) for c in target.columns]
    if mark:
        cols.append(F.when(cond, F.lit(UPDATED)).otherwise(F.lit(KEPT)).alias(ACTION))
    return j.select(*cols)


def wildcard_semi(target: DataFrame, staged: DataFrame, key: str, wild_key: str,
                  anti: bool = False) -> DataFrame:
    """Target rows having a staged row with the same key where the
    target's ``wild_key`` is NULL (matches any) or equal.  A NULL staged
    ``wild_key`` never matches.

    Written as two equi joins -- NULL wildcard on the key alone, set
    wildcard on (key, wild_key) -- so no condition runs over the pairs of
    one key.  ``anti=True`` gives the complement.
    """
    s_any = staged.filter(F.col(wild_key).isNotNull()).select(key)
    s_exact = staged.filter(F.col(wild_key).isNotNull()).select(key, wild_key)
    t_null = target.filter(F.col(wild_key).isNull())
    t_set = target.filter(F.col(wild_key).isNotNull())
    how = "left_anti" if anti else "left_semi"
    return (t_null.join(s_any, [key], how)
            .unionByName(t_set.join(s_exact, [key, wild_key], how)))


def wildcard_marker(target: DataFrame, staged: DataFrame, key: str, wild_key: str) -> DataFrame:
    """``target`` with a boolean ``_hit``: whether ``wildcard_semi`` keeps
    the row.  Two left joins in sequence against distinct key sets --
    (key, wild_key) for set wildcards, key alone for NULL ones -- so the
    target flows through one linear plan, no row is duplicated, and no
    condition runs over the pairs of a key."""
    pairs = staged.filter(F.col(wild_key).isNotNull()).select(key, wild_key).distinct()
    exact = pairs.withColumn("_hit_exact", F.lit(True))
    # derived from the distinct pairs, so the staged side is computed once
    # (the pairs' exchange is reused) and the key set is small already
    any_key = pairs.select(key).distinct().withColumn("_hit_any", F.lit(True))
    j = target.join(exact, [key, wild_key], "left").join(any_key, [key], "left")
    hit = F.when(F.col(wild_key).isNull(), F.col("_hit_any").isNotNull()).otherwise(F.col("_hit_exact").isNotNull())
    return j.select(*target.columns, hit.alias("_hit"))


def flag_wildcard(target: DataFrame, staged: DataFrame, key: str, wild_key: str,
                  flag_col: str, value, only_unflagged: bool, anti: bool,
                  mark: bool = False) -> DataFrame:
    """Set ``flag_col`` on the rows selected by ``wildcard_semi`` (or its
    complement with ``anti``), optionally only where the flag is still
    NULL."""
    ftype = dict((f.name, f.dataType) for f in target.schema.fields)[flag_col]
    m = wildcard_marker(target, staged, key, wild_key)
    sel = ~F.col("_hit") if anti else F.col("_hit")
    if only_unflagged:
        sel = sel & F.col(flag_col).isNull()
    out = m.withColumn(flag_col, F.when(sel, F.lit(value).cast(ftype)).otherwise(F.col(flag_col)))
    if mark:
        out = out.withColumn(ACTION, F.when(sel, F.lit(UPDATED)).otherwise(F.lit(KEPT)))
    return out.drop("_hit")
