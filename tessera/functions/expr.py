"""Scalar column expressions for derived features.

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def no_nan(x) -> Column:
    """NaN -> null (Spark keeps NaN and null apart; pandas does not)."""
    return F.nanvl(_c(x).cast("double"), F.lit(None).cast("double"))


def clip(x, lower: float | None = None, upper: float | None = None) -> Column:
    """``Series.clip``: bounds applied with greatest / least; null stays null."""
    out = no_nan(x)
    if lower is not None:
        out = F.when(out.isNull(), out).otherwise(F.greatest(out, F.lit(float(lower))))
    if upper is not None:
        out = F.when(out.isNull(), out).otherwise(F.least(out, F.lit(float(upper))))
    return out


def non_negative_or_zero(x) -> Column:
    """to_numeric -> clip(lower=0) -> fillna(0)."""
    return F.coalesce(clip(x, lower=0.0), F.lit(0.0))


def parse_number(x) -> Column:
    """Text to double; bad text -> null (X4).  ``try_cast`` keeps ANSI mode from failing."""
    return F.expr(f"try_cast({x} AS DOUBLE)") if isinstance(x, str) else x.try_cast("double")


def safe_ratio(num, den) -> Column:
    """max(num,0) / (max(den,0) + 1), missing -> 0; never Inf or NaN."""
    r = F.try_divide(non_negative_or_zero(num), non_negative_or_zero(den) + F.lit(1.0))
    return F.coalesce(F.nanvl(r, F.lit(None).cast("double")), F.lit(0.0))


def hour_of_step(step="step") -> Column:
    """(step - 1) mod 24 with a non-negative result."""
    return F.pmod(_c(step).cast("int") - 1, F.lit(24))


def right_closed_bins(x, edges: list[float], labels: list[str], include_lowest: bool = False) -> Column:
    """``pd.cut`` with right-closed bins (a, b]; outside -> null.

    ``Bucketizer`` is left-closed and is therefore not used.
    """
    v = _c(x)
    expr = None
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = (v > lo) & (v <= hi)
        if i == 0 and include_lowest:
            cond = (v >= lo) & (v <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def flag(cond: Column) -> Column:
    """Boolean to 0/1 int; null counts as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def discomfort_index(temp="temperature", humidity="humidity") -> Column:
    """0.81 T + 0.01 H (0.99 T - 14.3) + 46.3."""
    t, h = _c(temp), _c(humidity)
    return 0.81 * t + 0.01 * h * (0.99 * t - 14.3) + 46.3


def pct(x, digits: int = 2) -> Column:
    """x * 100 rounded."""
    return F.round(_c(x) * 100, digits)


# Fixed values of the scoring service.
RISK_LEVEL_LOW_RATIO = 0.5
HIGH_BALANCE_USAGE_RATIO = 0.9
LOW_RECEIVER_BALANCE = 100.0
NIGHT_HOURS = [0, 1, 2, 3, 4]
RISK_MESSAGES = [
    "amount exceeds the sender balance",
    "amount uses most of the sender balance",
    "transaction type is TRANSFER",
    "transaction type is CASH_OUT",
    "receiver balance is very low",
    "amount is above the large-transaction threshold of the training data",
    "night-time transaction",
]


def risk_level(prob="fraud_probability", threshold="threshold") -> Column:
    """Low below threshold * 0.5, Medium below threshold, else High."""
    p, t = _c(prob), _c(threshold)
    return (F.when(p < t * RISK_LEVEL_LOW_RATIO, "Low").when(p < t, "Medium").otherwise("High"))


def risk_factors(type_="transaction_type", amount="amount", sender="sender_old_balance",
                 receiver="receiver_old_balance", hour="transaction_hour", amount_threshold="amount_threshold") -> Column:
    """Triggered explanation rules, in fixed order."""
    a, s, r = _c(amount), _c(sender), _c(receiver)
    t, h, q = _c(type_), _c(hour), _c(amount_threshold)
    rule1 = (F.when(a > s, F.lit(RISK_MESSAGES[0]))
             .when((s > 0) & (F.try_divide(a, s) >= HIGH_BALANCE_USAGE_RATIO), F.lit(RISK_MESSAGES[1])))
    rule2 = F.when(t == "TRANSFER", F.lit(RISK_MESSAGES[2])).when(t == "CASH_OUT", F.lit(RISK_MESSAGES[3]))
    rule3 = F.when(r < LOW_RECEIVER_BALANCE, F.lit(RISK_MESSAGES[4]))
    rule4 = F.when(a > q, F.lit(RISK_MESSAGES[5]))
    rule5 = F.when(h.isin(*NIGHT_HOURS), F.lit(RISK_MESSAGES[6]))
    return F.filter(F.array(rule1, rule2, rule3, rule4, rule5), lambda x: x.isNotNull())
