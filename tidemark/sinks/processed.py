"""Writer of the processed zone."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.sources.delimited import PROCESSED_SEPARATOR, PROCESSED_TIMESTAMP

# A gzip file, and one with line breaks inside quotes, is read back by one task each.
ROWS_PER_FILE = 250_000


def write_processed(
    df: DataFrame,
    path: str,
    *,
    files: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    spread: bool = True,
) -> None:
    """Replaces ``path`` by gzipped ``|``-separated files with a header.

    Timestamps are cut to milliseconds. Null is written as nothing and an empty string as
    ``""``; both are null when read back. ``files`` fixes the number of writing tasks; left
    out, adaptive execution sizes the files. Without ``spread`` the tasks that hold the rows write
    them, for rows that a shuffle has dealt out already.
    """
    if files:
        df = df.repartition(files)
    elif spread:
        df = df.hint("rebalance")
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", PROCESSED_SEPARATOR)
        .option("quote", '"')
        .option("escape", '"')
        .option("compression", "gzip")
        .option("timestampFormat", PROCESSED_TIMESTAMP)
        .option("timestampNTZFormat", PROCESSED_TIMESTAMP)
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )
