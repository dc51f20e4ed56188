from tidemark.functions.legacy_time import legacy_timestamp, legacy_timestamp_invalid, unreadable
from tidemark.functions.text import collapse_whitespace

__all__ = ["collapse_whitespace", "legacy_timestamp", "legacy_timestamp_invalid", "unreadable"]
