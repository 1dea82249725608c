from rollcall.streaming.intake import (
    clean_exports, current_view, ingest_increment, read_exports, refresh_exports, stale_exports)

__all__ = [
    "clean_exports", "current_view", "ingest_increment", "read_exports", "refresh_exports", "stale_exports"]
