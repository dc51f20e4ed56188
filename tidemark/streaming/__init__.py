from tidemark.streaming.landing import ingest, read_landing, read_landing_files

__all__ = ["ingest", "read_landing", "read_landing_files"]
