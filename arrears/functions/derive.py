"""Scalar column functions (X1-X20): bands, codes, flags, date and text rules.

Every function takes and returns ``Column`` objects built from
``pyspark.sql.functions`` only, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# Bands are (inclusive upper bound, label) in ascending order; the value
# above the last bound gets the "above" label, NULL gets the default.
# --------------------------------------------------------------------------
VALUE_BANDS = [
    (500, "01. 0 a 500"),
    (1000, "02. 501 a 1000"),
    (2000, "03. 1001 a 2000"),
    (5000, "04. 2001 a 5000"),
    (7000, "05. 5001 a 7000"),
    (20000, "06. 7001 a 20000"),
    (80000, "07. 20000 a 80000"),
]
VALUE_ABOVE = "08. Acima de 80000"
NO_BAND = "00. Sem faixa"

NCOR_DELAY_BANDS = [
    (90, "01. Menor que 91"),
    (180, "02. 91 a 180"),
    (360, "03. 181 a 360"),
    (720, "04. 361 a 720"),
    (1200, "05. 721 a 1200"),
    (1500, "06. 1201 a 1500"),
    (1800, "07. 1501 a 1800"),
    (2300, "08. 1801 a 2300"),
]
NCOR_DELAY_ABOVE = "09. Acima de 2300"

BPF_DELAY_MIN = 5  # below this many days a BPF contract has no band
BPF_DELAY_BANDS = [
    (30, "01. 5 a 30"),
    (60, "02. 31 a 60"),
    (90, "03. 61 a 90"),
    (180, "04. 91 a 180"),
    (360, "05. 181 a 360"),
    (720, "06. 361 a 720"),
    (1200, "07. 721 a 1200"),
    (1500, "08. 1201 a 1500"),
    (1800, "09. 1501 a 1800"),
    (2300, "10. 1801 a 2300"),
]
BPF_DELAY_ABOVE = "11. Acima de 2300"

# Business-area codes per product line.
SUB_PRODUCT_CODES = [
    ("NCOR", ["02", "2", "11"]),
    ("BPF", ["01", "1"]),
]

# Score-cluster codes and the normalised code they map to.
SCORE_CODES = [
    ("A0", ["A0", "A00"]),
    ("A1", ["A1", "A01"]),
    ("A2", ["A2", "A02"]),
    ("A3", ["A3", "A03", "A04", "A4"]),
    ("W1", ["W1", "W01"]),
    ("W2", ["W2", "W02"]),
    ("W3", ["W3", "W03"]),
    ("W4", ["W4", "W04"]),
]

# Contact origins that do not count as an attended contact, and the
# classification that means right-party contact.
UNATTENDED_ORIGINS = [1, 5]
RIGHT_PARTY_CLASS = 1

# Default channel of an agreement with no call behind it.
DEFAULT_AGREEMENT_CHANNEL = "H"

# Sentinel standing for NULL in version compares, and the hour from which a
# run counts for the next day.
NULL_DATE_SENTINEL = "1900-01-01"
LATE_RUN_HOUR = 22

# Zero prefix of the digital dialer tax id and its final width.
TAX_ID_ZERO_PREFIX = "0000000"
TAX_ID_WIDTH = 14
SECONDS_PER_DAY = 86400
# --------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- literals ------------------------------------------------------------

def ts_lit(value) -> Column:
    """A timestamp literal without time zone (the driver tables and the
    warehouse keep local wall-clock time)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(str(value)).cast("timestamp_ntz")


def date_lit(value) -> Column:
    if isinstance(value, Column):
        return F.to_date(value)
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        value = value.isoformat()
    return F.to_date(F.lit(str(value)[:10]))


# ---- money ---------------------------------------------------------------

MONEY = "decimal(19,4)"
_MONEY_SCALE = 10_000


def money_sum(c) -> Column:
    """Exact sum of a ``decimal(19,4)`` column as ``decimal(19,4)``.

    Summing decimal(19,4) directly keeps a decimal(29,4) buffer, which
    Spark evaluates with big-decimal objects.  Summing the unscaled value
    as a long is exact (ANSI mode raises on overflow instead of wrapping)
    and stays in primitive arithmetic; the scale is put back once per
    group.  NULL when no row contributes, like ``sum``.
    """
    unscaled = (_col(c).cast(MONEY) * F.lit(_MONEY_SCALE)).cast("long")
    return (F.sum(unscaled).cast("decimal(19,0)") * F.lit(1 / _MONEY_SCALE).cast("decimal(5,4)")).cast(MONEY)


# ---- X1 / X2 / X3: bands and codes ---------------------------------------

def _bands(x: Column, bands, above: str | None, default: str) -> Column:
    expr = None
    for bound, label in bands:
        expr = F.when(x <= F.lit(bound), F.lit(label)) if expr is None else expr.when(x <= F.lit(bound), F.lit(label))
    if above is not None:
        expr = expr.when(x > F.lit(bands[-1][0]), F.lit(above))
    return expr.otherwise(F.lit(default))


def value_band(regularization, risk) -> Column:
    """Band of ``coalesce(regularization value, risk)``."""
    return _bands(F.coalesce(_col(regularization), _col(risk)), VALUE_BANDS, VALUE_ABOVE, NO_BAND)


def sub_product(area) -> Column:
    """Business area code to product line; NULL when not listed."""
    a = _col(area)
    expr = None
    for label, codes in SUB_PRODUCT_CODES:
        expr = F.when(a.isin(codes), F.lit(label)) if expr is None else expr.when(a.isin(codes), F.lit(label))
    return expr


def delay_band(sub_prod, days) -> Column:
    """Nested delay band, one ladder per product line."""
    s, d = _col(sub_prod), _col(days)
    ncor = _bands(d, NCOR_DELAY_BANDS, NCOR_DELAY_ABOVE, NO_BAND)
    bpf = F.when(d < F.lit(BPF_DELAY_MIN), F.lit(NO_BAND))
    for bound, label in BPF_DELAY_BANDS:
        bpf = bpf.when(d <= F.lit(bound), F.lit(label))
    bpf = bpf.when(d > F.lit(BPF_DELAY_BANDS[-1][0]), F.lit(BPF_DELAY_ABOVE)).otherwise(F.lit(NO_BAND))
    return (F.when(s == F.lit("NCOR"), ncor)
            .when(s == F.lit("BPF"), bpf)
            .otherwise(F.lit(NO_BAND)))


def score_code(*candidates) -> Column:
    """X3 + X5: the first non-NULL score code decides; unknown codes map to
    NULL (they do not fall through to the next candidate)."""
    c = F.coalesce(*[_col(x) for x in candidates]) if len(candidates) > 1 else _col(candidates[0])
    expr = None
    for label, codes in SCORE_CODES:
        expr = F.when(c.isin(codes), F.lit(label)) if expr is None else expr.when(c.isin(codes), F.lit(label))
    return expr


# ---- X4: contact flags ---------------------------------------------------

def attended_flag(origin, agreement) -> Column:
    """1 when the contact origin is not an unattended one (NOT IN keeps
    three-valued logic: a NULL origin gives no flag) or an agreement was
    made; NULL otherwise."""
    o, a = _col(origin), _col(agreement)
    return F.when((~o.isin(UNATTENDED_ORIGINS)) | a.isNotNull(), F.lit(1))


def right_party_flag(classification) -> Column:
    return F.when(_col(classification) == F.lit(RIGHT_PARTY_CLASS), F.lit(1))


def agreement_flag(agreement) -> Column:
    return F.when(_col(agreement).isNotNull(), F.lit(1))


# ---- X7 / X8: NULL-as-sentinel compares ----------------------------------

def differs_date(a, b) -> Column:
    """``isnull(a,'1900-01-01') <> isnull(b,'1900-01-01')``: NULL equals the
    sentinel date, never unknown."""
    s = ts_lit(NULL_DATE_SENTINEL)
    return F.coalesce(_col(a), s) != F.coalesce(_col(b), s)


def same_date(a, b) -> Column:
    s = ts_lit(NULL_DATE_SENTINEL)
    return F.coalesce(_col(a), s) == F.coalesce(_col(b), s)


def differs_num(a, b) -> Column:
    """``isnull(n,'') <> isnull(m,'')`` on numbers: '' converts to 0."""
    return F.coalesce(_col(a), F.lit(0)) != F.coalesce(_col(b), F.lit(0))


# ---- X9 - X15: dates -----------------------------------------------------

def days_between(start, end) -> Column:
    """``datediff(day, start, end)``, calendar-day boundaries."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def seconds_between(start, end) -> Column:
    """``datediff(second, start, end)`` -- second boundaries crossed,
    computed on wall-clock (NTZ) values, so no session time zone or DST
    change enters."""
    return F.timestamp_diff("SECOND", F.date_trunc("second", _col(start)), F.date_trunc("second", _col(end)))


def is_monday(d) -> Column:
    """``datepart(dw, d) = 2`` under the default first day (Sunday)."""
    return F.dayofweek(_col(d)) == F.lit(2)


def previous_business_day(d) -> Column:
    """Monday goes back to Friday, any other day one day back."""
    d = F.to_date(_col(d))
    return F.when(is_monday(d), F.date_sub(d, 3)).otherwise(F.date_sub(d, 1))


def since_midnight(ts, as_of) -> Column:
    """at or after midnight of ``as_of``'s day."""
    return _col(ts) >= date_lit(as_of).cast("timestamp_ntz")


def on_day(ts, day) -> Column:
    """calendar day of ``ts`` equals ``day``."""
    return F.to_date(_col(ts)) == date_lit(day)


def seconds_to_day_fraction(n) -> Column:
    """``convert(float, n) / 86400``."""
    return _col(n).cast("double") / F.lit(float(SECONDS_PER_DAY))


def _as_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])


def as_of_date(as_of) -> _dt.date:
    return _as_date(as_of)


# ---- X17 - X19: text -----------------------------------------------------

def area_code(phone) -> Column:
    """First two characters of the dialled number."""
    return F.substring(_col(phone), 1, 2)


def local_number(phone) -> Column:
    """Last nine characters of the dialled number."""
    return F.right(_col(phone), F.lit(9))


def pad_tax_id(tax_id) -> Column:
    """``right('0000000' + s, 14)`` -- seven zeros are prepended, so
    ids shorter than seven digits stay shorter than 14 (D7)."""
    return F.right(F.concat(F.lit(TAX_ID_ZERO_PREFIX), _col(tax_id)), F.lit(TAX_ID_WIDTH))


def empty_to_null(s) -> Column:
    """X19."""
    return F.nullif(_col(s), F.lit(""))
