from tidegauge.sources.files import (
    access_log, delimited, inline_rows, key_value_lines, write_bucketed_parquet, write_delimited,
)
from tidegauge.sources.queue import decode_messages, queue_options, read_topic

__all__ = [
    "access_log", "delimited", "inline_rows", "key_value_lines", "write_bucketed_parquet",
    "write_delimited", "decode_messages", "queue_options", "read_topic",
]
