"""SQL fragments over the wide six-month history (1 = newest, 6 = oldest).

Features are kept as SQL text: Spark parses one string per column, which costs the
driver far less than assembling the same expression from hundreds of column objects.
"""

from __future__ import annotations

from collections.abc import Iterable

MONTHS = tuple(range(1, 7))

PAY_STATUS = tuple(f"pay_status_{i}" for i in MONTHS)
BILL = tuple(f"bill_amt_{i}" for i in MONTHS)
PAY = tuple(f"pay_amt_{i}" for i in MONTHS)


def total(terms: Iterable[str]) -> str:
    """Left-to-right sum, so double results do not depend on the planner."""
    return f"({' + '.join(terms)})"


def count_where(names: Iterable[str], test: str) -> str:
    """How many of the named columns pass ``test``; NULL does not."""
    return total(f"if({n} {test}, 1, 0)" for n in names)


def ratio(numerator: str, denominator: str) -> str:
    """Division of doubles that is NULL on a zero denominator."""
    return f"({numerator} / nullif({denominator}, 0.0D))"


def greatest(names: Iterable[str]) -> str:
    return f"greatest({', '.join(names)})"
