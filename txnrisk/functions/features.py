"""Row-local transaction features as SQL text.

SQL text rather than Column objects, because a fitted pipeline stores it in a
``SQLTransformer`` stage and so can be saved and loaded without Python code.
"""

from __future__ import annotations

from txnrisk.sources.schema import CATEGORICAL, HISTORY

TIME_FEATURES = ["hour_sin", "hour_cos", "weekday_sin", "weekday_cos", "is_weekend"]
HISTORY_FEATURES = [
    "log_average_spend", "amount_to_average", "amount_minus_average", "log_account_age", "log_previous_txns",
]
PREFIX = "f_"


def _number_rule(name: str) -> str:
    value = f"cast({name} as double)"
    ok = f"{value} >= 0 and {value} < double('infinity') and not isnan({value})"
    if name == "is_intl":
        ok = f"{value} in (0D, 1D)"
    elif name in ("previous_txns", "account_age_days"):
        ok += f" and {value} = floor({value})"
    return f"case when {ok} then {value} end"


def numeric_inputs(include_history: bool) -> list[str]:
    return ["amount", "is_intl", *(HISTORY if include_history else [])]


def numeric_features(include_history: bool) -> list[str]:
    """Numeric feature names in model order, without prefix."""
    names = [*numeric_inputs(include_history), *TIME_FEATURES, "log_amount"]
    return names + (HISTORY_FEATURES if include_history else [])


def categorical_features(include_keyword: bool) -> list[str]:
    return [*CATEGORICAL, *(["keyword"] if include_keyword else [])]


def feature_sql(include_history: bool = False, include_keyword: bool = False) -> dict[str, str]:
    """Feature name -> SQL expression over the engine's input columns."""
    num = {c: _number_rule(c) for c in numeric_inputs(include_history)}
    out = dict(num)
    hour = "(hour(txn_ts) + minute(txn_ts) / 60D)"
    out["hour_sin"] = f"sin(2D * pi() * {hour} / 24D)"
    out["hour_cos"] = f"cos(2D * pi() * {hour} / 24D)"
    out["weekday_sin"] = "sin(2D * pi() * weekday(txn_ts) / 7D)"
    out["weekday_cos"] = "cos(2D * pi() * weekday(txn_ts) / 7D)"
    out["is_weekend"] = "case when txn_ts is not null then if(weekday(txn_ts) >= 5, 1D, 0D) end"
    out["log_amount"] = f"log1p({num['amount']})"
    if include_history:
        out["log_average_spend"] = f"log1p({num['average_spend']})"
        out["amount_to_average"] = f"({num['amount']}) / nullif({num['average_spend']}, 0D)"
        out["amount_minus_average"] = f"({num['amount']}) - ({num['average_spend']})"
        out["log_account_age"] = f"log1p({num['account_age_days']})"
        out["log_previous_txns"] = f"log1p({num['previous_txns']})"
    for c in categorical_features(include_keyword):
        out[c] = f"nullif(trim(cast({c} as string)), '')"
    return out


def feature_select(include_history: bool = False, include_keyword: bool = False) -> str:
    """Statement for a ``SQLTransformer``: all input columns plus prefixed features."""
    cols = ", ".join(f"{e} AS {PREFIX}{n}" for n, e in feature_sql(include_history, include_keyword).items())
    return f"SELECT *, {cols} FROM __THIS__"
