"""Marts and other queries; importing this package registers all of them."""

from tierline.plans import control_queries, credit_marts, customer_marts, database_queries, layers, merchant_marts, model_queries, more_queries, risk_marts, storage_queries, serving, stream_queries  # noqa: F401
from tierline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
