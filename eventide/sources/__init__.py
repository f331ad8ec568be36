"""Readers: the reference's CSV / access-log inputs (S1-S8) and the driver tables."""

from eventide.sources.schemas import (
    USER_BEHAVIOR, AD_CLICK, LOGIN, ORDER_PAY, RECEIPT, MARKETING,
)
from eventide.sources.files import (
    read_user_behavior, read_ad_clicks, read_logins, read_orders, read_receipts,
    read_access_log, read_marketing, read_lines, read_branches, ReadResult,
    parse_access_log, parse_csv,
)
from eventide.sources.tables import TABLES, read_table, events

__all__ = [
    "USER_BEHAVIOR", "AD_CLICK", "LOGIN", "ORDER_PAY", "RECEIPT", "MARKETING",
    "read_user_behavior", "read_ad_clicks", "read_logins", "read_orders", "read_receipts",
    "read_access_log", "read_marketing", "read_lines", "read_branches", "ReadResult", "parse_access_log", "parse_csv", "TABLES", "read_table", "events",
]
