from tidemark.sources.delimited import raw_glob, read_delimited, read_processed, read_raw

__all__ = ["raw_glob", "read_delimited", "read_processed", "read_raw"]
