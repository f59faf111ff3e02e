"""Scalar column expressions (FUN-01 .. FUN-19).

Every function returns a ``Column`` built from built-in expressions, so the
whole feature vector stays inside whole-stage codegen: no Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskframe.functions.time import epoch_micros

# ---- fixed values that must equal the reference's ---------------------------------
# Category maps of the scoring service (anything else, and null, is -1).
CATEGORY_MAPS: dict[str, dict[str, int]] = {
    "card4": {"visa": 0, "mastercard": 1, "discover": 2, "american express": 3},
    "card6": {"credit": 0, "debit": 1},
    "ProductCD": {"W": 0, "C": 1, "R": 2, "H": 3, "S": 4},
}
# Risk tiers: probability < 0.3 LOW, < 0.6 MEDIUM, < 0.8 HIGH, else CRITICAL.
RISK_TIERS = ((0.3, "LOW"), (0.6, "MEDIUM"), (0.8, "HIGH"))
RISK_TOP = "CRITICAL"
FRAUD_THRESHOLD = 0.5
LABEL_NAMES = ("legitimate", "fraud")
# ---------------------------------------------------------------------------------------


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c) -> Column:
    """FUN-01: text or number to double; anything unparsable becomes null."""
    return F.expr(f"try_cast({c} as double)") if isinstance(c, str) else c.try_cast("double")


def to_number_or_zero(c) -> Column:
    """PRJ-08: coerce to a number, failures to 0."""
    return F.coalesce(to_number(c), F.lit(0.0))


def d_delta(d, dt) -> Column:
    """FUN-02: ``D - TransactionDT`` where both are present, else D unchanged."""
    d, dt = col_of(d), col_of(dt)
    return F.when(d.isNotNull() & dt.isNotNull(), d - dt).otherwise(d)


def cents(amount, scale: int = 1) -> Column:
    """FUN-03: fractional part of the amount (truncation toward zero), times ``scale``."""
    a = col_of(amount)
    frac = a - a.try_cast("bigint")
    return frac * F.lit(float(scale)) if scale != 1 else frac


def ratio_to_mean(amount, mean, guard: bool = True) -> Column:
    """FUN-04: amount / mean; with ``guard`` 0 when the mean is not positive."""
    a, m = col_of(amount), col_of(mean)
    return F.when(m > 0, a / m).otherwise(F.lit(0.0)) if guard else F.try_divide(a, m)


def key_text(c, token: str | None = "nan") -> Column:
    """Text form of a key column, nulls replaced by ``token`` (null kept if token is None)."""
    t = col_of(c).cast("string")
    return F.coalesce(t, F.lit(token)) if token is not None else t


def combine_keys(cols: Iterable, token: str | Mapping[str, str] = "nan") -> Column:
    """FUN-05: ``a_b_c`` key from several columns (missing parts become ``token``)."""
    parts = []
    for c in cols:
        tok = token.get(c, "nan") if isinstance(token, Mapping) else token
        parts.append(key_text(c, tok))
    return F.concat_ws("_", *parts)


def category_code(c, mapping: Mapping[str, int]) -> Column:
    """FUN-07: fixed category map; unknown values and null give -1."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, col_of(c)), F.lit(-1))


def risk_level(p) -> Column:
    """FUN-10: probability to LOW / MEDIUM / HIGH / CRITICAL."""
    p = col_of(p)
    expr = None
    for bound, name in RISK_TIERS:
        expr = F.when(p < bound, name) if expr is None else expr.when(p < bound, name)
    return expr.otherwise(RISK_TOP)


def is_fraud(pred) -> Column:
    """FUN-11: decision from the predicted value (``>= 0.5``)."""
    return col_of(pred) >= F.lit(FRAUD_THRESHOLD)


def label_name(flag) -> Column:
    return F.when(col_of(flag), LABEL_NAMES[1]).otherwise(LABEL_NAMES[0])


def transaction_code(ts, key) -> Column:
    """FUN-12: ``TXN_<yyyyMMddHHmmssffffff>_<key>``; the key suffix removes same-microsecond collisions."""
    return F.concat(F.lit("TXN_"), F.date_format(col_of(ts), "yyyyMMddHHmmssSSSSSS"),
                    F.lit("_"), col_of(key).cast("string"))


def outlier_flag(score, threshold) -> Column:
    """FUN-17: anomaly score above the threshold -> 1 (fraud), else 0."""
    return F.when(col_of(score) > threshold, 1).otherwise(0)


def trace_sampled(trace_id, ratio: float) -> Column:
    """FUN-19: keep a whole trace when the first 4 hex digits of md5(id) fall below ``ratio``.

    String comparison of lower-case hex is numeric comparison, so DuckDB's
    ``md5`` gives the same decision.
    """
    cut = f"{min(max(int(ratio * 65536), 0), 65536):04x}"
    h = F.substring(F.md5(col_of(trace_id).cast("string")), 1, 4)
    return F.lit(True) if ratio >= 1.0 else h < F.lit(cut)


def micros_of(ts) -> Column:
    return epoch_micros(col_of(ts))


def round_sig(c, digits: int = 7) -> Column:
    """Round to ``digits`` significant digits (comparisons of large-magnitude float aggregates)."""
    x = col_of(c)
    p = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))))
    return F.when(x.isNull() | (x == 0), x).otherwise(F.round(x / p, digits - 1) * p)


def round_sig_sql(expr: str, digits: int = 7) -> str:
    """DuckDB twin of ``round_sig``."""
    p = f"pow(10.0, floor(log10(abs({expr}))))"
    return f"CASE WHEN {expr} IS NULL OR {expr} = 0 THEN {expr} ELSE round({expr} / {p}, {digits - 1}) * {p} END"
