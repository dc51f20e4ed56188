from tidemark.sinks.bucketed import BucketedTable, merged_over_salts
from tidemark.sinks.processed import write_processed
from tidemark.sinks.tables import Database

__all__ = ["BucketedTable", "Database", "merged_over_salts", "write_processed"]
