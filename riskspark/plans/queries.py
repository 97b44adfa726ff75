"""Registered queries: every operator of the inventory bound to the driver
tables (FIXTURES.md part 2), each with an equivalent DuckDB SQL text.

Query names start with the inventory id (``w7_label`` = W7).  Nothing here
subsets rows: every query reads whole tables.
"""

from __future__ import annotations

from riskspark.plans.registry import REGISTRY, register  # noqa: F401
from riskspark.sources.bindings import txn_view
from riskspark.plans.sqlparts import LAB, LABEL_COLS_SQL
from riskspark.plans import q_basic, q_cards, q_eval, q_io, q_models  # noqa: F401
from riskspark.operators.label import label_transactions

@register("w7_label_transactions", f"{LAB} select {LABEL_COLS_SQL} from lab")
def w7_label(spark, sf):
    return label_transactions(txn_view(spark, sf))
