"""Watermarks and extracts of the incremental loads.

A watermark is a batch high-water mark kept in the run log: the day from
which a load re-reads changed source rows.  It is computed per job with
partial aggregates (skew-safe: one hot job adds no task imbalance), and
used as a scalar subquery (``DataFrame.scalar()``) so the whole load stays
one plan and the value reaches the Parquet scan as a pushed filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.functions.derive import LATE_RUN_HOUR, date_lit, previous_business_day
from arrears.operators.joins import key_set

DONE = "Concluida"
RUNNING = "Executando"
FAILED = "Erro"

JOB, RUN_ID, START, STATUS = "nome_procedure", "id_execucao", "data_hora_inicio", "status_execucao"


def _forward(last_start: Column) -> Column:
    """Day of the last start, or the next day if it started at 22 h or later."""
    d = F.to_date(last_start)
    return F.when(F.hour(last_start) >= F.lit(LATE_RUN_HOUR), F.date_add(d, 1)).otherwise(d)


def _backward(last_start: Column) -> Column:
    """One day before the last start, two if it started at 22 h or later."""
    d = F.to_date(last_start)
    return F.when(F.hour(last_start) >= F.lit(LATE_RUN_HOUR), F.date_sub(d, 2)).otherwise(F.date_sub(d, 1))


def _done(runs: DataFrame, jobs: Sequence[str] | None) -> DataFrame:
    ok = runs.filter(F.col(STATUS) == F.lit(DONE))
    if jobs:
        ok = ok.filter(F.col(JOB).isin(list(jobs)))
    return ok


def last_successful_start(runs: DataFrame, jobs: Sequence[str] | None = None) -> DataFrame:
    """(job, last_start) over runs that finished ``Concluida``; later runs
    with ``Erro`` or ``Executando`` are ignored."""
    return (_done(runs, jobs).groupBy(JOB)
            .agg(F.max(START).alias("ultima_execucao")))


def watermark_forward(runs: DataFrame, jobs: Sequence[str] | None = None) -> DataFrame:
    """W1 + A5 per job: (nome_procedure, ultima_execucao, watermark)."""
    last = last_successful_start(runs, jobs)
    return last.withColumn("watermark", _forward(F.col("ultima_execucao")))


def watermark_backward(runs: DataFrame, jobs: Sequence[str] | None = None) -> DataFrame:
    """W2 + A5 per job."""
    last = last_successful_start(runs, jobs)
    return last.withColumn("watermark", _backward(F.col("ultima_execucao")))


def watermark_penultimate(runs: DataFrame, jobs: Sequence[str] | None = None) -> DataFrame:
    """W3 + J13 per (parent) job: the forward form over the successful runs
    before the job's latest successful run.  Runs are ordered by their start
    (then id): the ids of the run log are random.

    The per-job maximum is a partial aggregate; joining it back is an equi
    join on the job name whose small side has one row per job (AQE
    broadcasts it at run time), followed by a second partial aggregate, so
    no job's runs are ever gathered in one task.
    """
    ok = _done(runs, jobs).select(JOB, F.struct(START, RUN_ID).alias("_run"))
    latest = ok.groupBy(JOB).agg(F.max("_run").alias("_latest"))
    earlier = (ok.join(latest, JOB, "inner")
               .filter(F.col("_run") < F.col("_latest"))
               .groupBy(JOB).agg(F.max(f"_run.{START}").alias("ultima_execucao")))
    return earlier.withColumn("watermark", _forward(F.col("ultima_execucao")))


def with_payment_date(watermarks: DataFrame) -> DataFrame:
    """Previous business day of each watermark."""
    return watermarks.withColumn("data_pagamento", previous_business_day(F.col("watermark")))


def watermark_of(runs: DataFrame, job: str, form: str = "forward") -> Column:
    """Scalar watermark of one job as a column (scalar subquery)."""
    fn = {"forward": watermark_forward, "backward": watermark_backward,
          "penultimate": watermark_penultimate}[form]
    return fn(runs, [job]).select("watermark").scalar()


def as_watermark(w) -> Column:
    """Accept a literal date, a string, a scalar ``Column``, or None (no
    successful run yet: a NULL date)."""
    if w is None:
        return F.lit(None).cast("date")
    return w if isinstance(w, Column) else date_lit(w)


# ---- high-water extracts -------------------------------------------------

def high_water(target: DataFrame, id_col: str) -> Column:
    """A3: ``coalesce(max(id), 0)`` of the target as a scalar subquery."""
    return target.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).scalar()


def extract_new(source: DataFrame, target: DataFrame, id_col: str,
                where: Column | None = None) -> DataFrame:
    """H1 / H2: source rows above the target's high-water id, with an
    optional constant filter, distinct (A7)."""
    out = source.filter(F.col(id_col) > high_water(target, id_col))
    if where is not None:
        out = out.filter(where)
    return out.distinct()


def _version_ts(watermark) -> Column:
    w = as_watermark(watermark)
    return w.cast("timestamp_ntz")


def _values(df: DataFrame, *scalars: Column) -> tuple:
    """The values of scalars, read in one job before the plan is built: the
    filter on the source is then a plain comparison with literals, which
    reaches its scan."""
    return tuple(df.sparkSession.range(1).select(*(s.alias(f"v{i}") for i, s in enumerate(scalars))).first())


def _at_or_after(col: str, w) -> Column:
    return F.col(col) >= F.lit(w).cast("timestamp_ntz")


def extract_new_or_changed(source: DataFrame, target: DataFrame, id_col: str,
                           version_col: str, watermark, inclusive: bool = False,
                           on_null_watermark: str = "all") -> DataFrame:
    """H3 / H4: ``id > max`` (``>=`` when inclusive) or ``version >= watermark``.

    A NULL watermark (no successful run yet) selects every row with
    ``on_null_watermark="all"`` and none of the version branch with
    ``"none"`` -- the reference's behaviour (D3).
    """
    w, highest = _values(source, _version_ts(watermark), high_water(target, id_col))
    if w is None and on_null_watermark == "all":
        return source.distinct()
    hw = F.lit(highest)
    cond = F.col(id_col) >= hw if inclusive else F.col(id_col) > hw
    return source.filter(cond if w is None else cond | _at_or_after(version_col, w)).distinct()


def extract_id_or_date(source: DataFrame, target: DataFrame, id_col: str,
                       date_col: str, watermark,
                       on_null_watermark: str = "all") -> DataFrame:
    """By id above the target's maximum when the target has rows,
    else by date from the watermark."""
    m, w = _values(source, target.agg(F.max(id_col).alias("m")).scalar(), _version_ts(watermark))
    if m is not None:
        return source.filter(F.col(id_col) > F.lit(m))
    if w is None:
        return source if on_null_watermark == "all" else source.filter(F.lit(False))
    return source.filter(_at_or_after(date_col, w))


def extract_multi_date(source: DataFrame, date_cols: Sequence[str], watermark) -> DataFrame:
    """H6: any of several dates at or after the watermark."""
    w = _version_ts(watermark)
    cond = None
    for c in date_cols:
        cond = (F.col(c) >= w) if cond is None else (cond | (F.col(c) >= w))
    return source.filter(cond)


def extract_by_child_dates(parents: DataFrame, children: DataFrame, key: str | Sequence[str],
                           paid_col: str, due_col: str, watermark, pay_date,
                           as_of) -> DataFrame:
    """H7: parents having a child paid from the payment date on, or falling
    due between the watermark and ``as_of``'s day (closed range, F3)."""
    w = as_watermark(watermark)
    p = as_watermark(pay_date)
    hit = children.filter((F.to_date(F.col(paid_col)) >= p)
                          | F.to_date(F.col(due_col)).between(w, date_lit(as_of)))
    return parents.join(key_set(hit, key), key, "left_semi")


def parents_in_scope(parents: DataFrame, key: str, date_cols: Sequence[str], watermark) -> DataFrame:
    """Key list of parents included / cancelled / approved since the
    watermark (the CTE of the parent-scoped loads)."""
    return extract_multi_date(parents, date_cols, watermark).select(key)


def extract_children(children: DataFrame, key: str, scope: DataFrame | Sequence[DataFrame]) -> DataFrame:
    """H8 + U1 + J6: children whose parent key is in the union of one or
    more key lists.  The union is not deduplicated -- a semi join only asks
    for existence."""
    if isinstance(scope, DataFrame):
        scope = [scope]
    keys = scope[0].select(key)
    for s in scope[1:]:
        keys = keys.unionByName(s.select(key))
    return children.join(key_set(keys, key), key, "left_semi")


def extract_due_children(children: DataFrame, key: str, scope: DataFrame,
                         paid_col: str, due_col: str, watermark, pay_date, as_of) -> DataFrame:
    """U2 + F3: children of in-scope parents, plus (union all) children
    paid exactly on the payment date or due between watermark and today.
    Both branches keep duplicates, as ``union all`` does (D23)."""
    w = as_watermark(watermark)
    p = as_watermark(pay_date)
    in_scope = children.join(key_set(scope, key), key, "left_semi")
    by_date = children.filter((F.to_date(F.col(paid_col)) == p)
                              | F.to_date(F.col(due_col)).between(w, date_lit(as_of)))
    return in_scope.unionByName(by_date)


def target_is_empty(target: DataFrame) -> bool:
    """Emptiness probe (``top 1``); reads at most one row."""
    return target.limit(1).isEmpty()


def extract_instalments(source: DataFrame, target: DataFrame, keys: Sequence[str],
                        version_col: str, inclusion_col: str, state_col: str,
                        open_value: str, watermark) -> DataFrame:
    """H9 + F11: on the first load (empty target) open rows or rows changed
    since the watermark; afterwards rows changed or included since the
    watermark that the target does not hold with the same version."""
    w, = _values(source, _version_ts(watermark))
    if target_is_empty(target):
        open_ = F.col(state_col) == F.lit(open_value)
        return source.filter(open_ if w is None else open_ | _at_or_after(version_col, w))
    changed = source.filter(F.lit(False) if w is None else _at_or_after(version_col, w) | _at_or_after(inclusion_col, w))
    from arrears.operators.merge import drop_unchanged
    return drop_unchanged(changed, target, keys, [version_col])


def extract_by_parent_state(children: DataFrame, parents: DataFrame, key: str | Sequence[str],
                            state_col: str, open_value: str, version_col: str,
                            watermark, not_null_col: str | None = None) -> DataFrame:
    """H10 + J7: children (optionally with a non-NULL column) whose parent
    is open or changed since the watermark.  The OR on the parent side is
    applied before the semi join, so only qualifying keys are shuffled."""
    w = _version_ts(watermark)
    qualifying = parents.filter((F.col(state_col) == F.lit(open_value))
                                | F.coalesce(F.col(version_col) >= w, F.lit(False)))
    out = children
    if not_null_col:
        out = out.filter(F.col(not_null_col).isNotNull())
    keys = [key] if isinstance(key, str) else list(key)
    return out.join(key_set(qualifying, keys), keys, "left_semi")


def on_day_before(df: DataFrame, col: str, as_of) -> DataFrame:
    """rows whose calendar day is the day before ``as_of``."""
    return df.filter(F.to_date(F.col(col)) == F.date_sub(date_lit(as_of), 1))


def since(df: DataFrame, col: str, as_of) -> DataFrame:
    """F7 as a frame filter."""
    return df.filter(F.col(col) >= date_lit(as_of).cast("timestamp_ntz"))

