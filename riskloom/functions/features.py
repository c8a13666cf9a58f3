"""The 32 behavioural features as SQL expressions over a clean account row."""

from __future__ import annotations

from riskloom.functions.months import (
    BILL,
    MONTHS,
    PAY,
    PAY_STATUS,
    count_where,
    greatest,
    ratio,
    total,
)


def utilization(i: int) -> str:
    """Share of the limit drawn in month ``i``."""
    return ratio(f"bill_amt_{i}", "limit_bal")


def payment_ratio(i: int) -> str:
    """Payment of month ``i`` against the statement it settles, that of month ``i + 1``."""
    return ratio(f"pay_amt_{i}", f"bill_amt_{i + 1}")


MEAN_BILL = f"({total(BILL)} / 6.0D)"


def _bill_volatility() -> str:
    # Deviations from the mean, not E[b^2] - E[b]^2: the difference of two squares
    # loses every digit when balances are large and steady.
    squares = (f"({b} - {MEAN_BILL}) * ({b} - {MEAN_BILL})" for b in BILL)
    return f"sqrt({total(squares)} / 6.0D)"


def helper_columns() -> dict[str, str]:
    """Per-month columns the features are built from."""
    return {
        **{f"utilization_{i}": utilization(i) for i in MONTHS},
        **{f"payment_ratio_{i}": payment_ratio(i) for i in MONTHS[:-1]},
        "avg_bill_amt_sq": f"{total(f'{b} * {b}' for b in BILL)} / 6.0D",
    }


def demographic_features() -> dict[str, str]:
    return {c: c for c in ("limit_bal", "education", "marriage", "age")}


def status_features() -> dict[str, str]:
    return {c: c for c in PAY_STATUS}


def utilization_features() -> dict[str, str]:
    return {
        "avg_utilization": f"{total(utilization(i) for i in MONTHS)} / 6.0D",
        "max_utilization": greatest(utilization(i) for i in MONTHS),
        "utilization_trend": f"{utilization(1)} - {utilization(6)}",
        "credit_headroom": ratio("(limit_bal - bill_amt_1)", "limit_bal"),
    }


def payment_features() -> dict[str, str]:
    # Six payments over five statements; NULL for an account nobody billed.
    billed = total(BILL[1:])
    settled = total(f"coalesce({payment_ratio(i)}, 0.0D)" for i in MONTHS[:-1])
    return {
        "avg_payment_ratio": f"{settled} / 5.0D",
        "overall_payment_ratio": ratio(total(PAY), billed),
        # Also 0 when positive and negative statements cancel out.
        "has_billing_history": f"if({billed} <> 0, 1, 0)",
        "months_zero_payment": count_where(PAY, "= 0"),
        "total_paid_6m": total(PAY),
    }


def delinquency_features() -> dict[str, str]:
    late = count_where(PAY_STATUS, ">= 1")
    return {
        "recent_delinquency": "pay_status_1",
        "max_delinquency": greatest(PAY_STATUS),
        "months_delinquent": late,
        "delinquency_trend": "pay_status_1 - pay_status_6",
        "months_revolving": count_where(PAY_STATUS, "= 0"),
        "months_paid_duly": count_where(PAY_STATUS, "= -1"),
        "months_no_consumption": count_where(PAY_STATUS, "= -2"),
        "ever_delinquent": f"if({late} > 0, 1, 0)",
    }


def dynamics_features() -> dict[str, str]:
    over = count_where(BILL, "> limit_bal")
    return {
        "avg_bill_amt": MEAN_BILL,
        "bill_volatility": _bill_volatility(),
        "months_over_limit": over,
        "ever_over_limit": f"if({over} > 0, 1, 0)",
        "net_balance_ratio": ratio("(bill_amt_1 - pay_amt_1)", "limit_bal"),
    }


FAMILIES = {
    "demographics": demographic_features,
    "status": status_features,
    "utilization": utilization_features,
    "payment": payment_features,
    "delinquency": delinquency_features,
    "dynamics": dynamics_features,
}


def all_features() -> dict[str, str]:
    """Every feature by name, in output order."""
    return {name: text for family in FAMILIES.values() for name, text in family().items()}


def aliased(columns: dict[str, str]) -> list[str]:
    """``selectExpr`` arguments."""
    return [name if text == name else f"{text} AS {name}" for name, text in columns.items()]
