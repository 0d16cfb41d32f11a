from adfuse.streaming.by_file import read_rollup, start_rollup_by_file
from adfuse.streaming.daily import read_daily_rollup, read_feed_stream, start_daily_rollup, write_daily_rollup

__all__ = [
    "read_daily_rollup", "read_feed_stream", "read_rollup", "start_daily_rollup", "start_rollup_by_file", "write_daily_rollup",
]
