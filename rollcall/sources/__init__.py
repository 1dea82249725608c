from rollcall.sources.buckets import read_bucketed, write_bucketed
from rollcall.sources.files import (
    read_bronze, read_malformed, read_metadata, read_silver, write_csv, write_json, write_silver, write_table)
from rollcall.sources.store import Store
from rollcall.sources.trade_view import bronze_view, order_count, snapshots

__all__ = [
    "Store", "bronze_view", "order_count", "read_bronze", "read_bucketed", "read_metadata", "read_silver", "snapshots",
    "write_bucketed", "write_csv", "write_json", "write_silver", "write_table",
]
