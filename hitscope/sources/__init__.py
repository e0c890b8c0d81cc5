"""Readers and writers for log lines, log messages and key/value text."""

from hitscope.sources.key_value import key_value_rows, read_kv_text, sorted_pairs, write_kv_text
from hitscope.sources.lines import read_log_lines
from hitscope.sources.messages import decode_messages, read_log_stream

__all__ = [
    "decode_messages",
    "key_value_rows",
    "read_kv_text",
    "read_log_lines",
    "read_log_stream",
    "sorted_pairs",
    "write_kv_text",
]
