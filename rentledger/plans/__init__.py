"""Whole reports."""

from .layered import clamped_order_report, clean_layer, order_total_report, payments_view, refund_report
from .order_report import order_report
from .transaction_report import transaction_report

__all__ = [
    "clamped_order_report",
    "clean_layer",
    "order_report",
    "order_total_report",
    "payments_view",
    "refund_report",
    "transaction_report",
]
