"""SQL text shared by the DuckDB oracle: frame CTEs and per-column fan-outs."""

from __future__ import annotations

from ferret.plans.frames import (MODEL_FRAME_SQL, ORDERS_FRAME_SQL, REGRESSION_PAIRS_SQL,
                                 SCORED_MANY_SQL, SCORED_SQL)

ORDERS_COLS = ["row_id", "OrderId", "price", "acctbal", "priority", "segment",
               "nationkey", "bucket", "const_col", "label"]
ORDERS_KIND = {"row_id": "integral", "OrderId": "integral", "price": "fractional",
               "acctbal": "fractional", "priority": "string", "segment": "string",
               "nationkey": "integral", "bucket": "integral", "const_col": "fractional",
               "label": "integral"}
# numeric features of orders_frame under the role rules at sf0.01
NUMERIC = ["price", "acctbal", "bucket"]
CATEGORIC = ["priority", "nationkey", "bucket"]


def with_frame(body: str, frame: str = "orders") -> str:
    src = {"orders": ORDERS_FRAME_SQL, "model": MODEL_FRAME_SQL, "scored": SCORED_SQL,
           "scored_many": SCORED_MANY_SQL, "regression_pairs": REGRESSION_PAIRS_SQL}[frame]
    return f"WITH f AS ({src})\n{body}"


def union_per_column(template: str, cols: list[str]) -> str:
    """``template`` uses {c} for the column; one SELECT per column, UNION ALL."""
    return "\nUNION ALL\n".join(template.format(c=c) for c in cols)


def null_counts_sql(cols: list[str] = ORDERS_COLS) -> str:
    return union_per_column(
        "SELECT '{c}' AS feature, count(*) - count({c}) AS null_count, count(*) AS n FROM f", cols)
