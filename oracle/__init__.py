"""Checking SQL for every registered query that SQL can express."""

from __future__ import annotations


def checking_sql() -> dict[str, str]:
    from oracle.operations import operations_sql
    from oracle.operators import operator_sql
    from oracle.orders import order_sql

    return {**order_sql(), **operations_sql(), **operator_sql()}
