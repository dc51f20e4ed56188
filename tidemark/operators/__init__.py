from tidemark.operators.latest import latest
from tidemark.operators.quality import EmptyTableError, duplicate_keys, require_rows, row_counts
from tidemark.operators.ranking import best_of, enrich, key_metrics, top_k, top_k_enriched
from tidemark.operators.pruning import top_k_counted
from tidemark.operators.upsert import align, upsert, upsert_newest
from tidemark.operators.window import in_open_window

__all__ = [
    "EmptyTableError",
    "align",
    "best_of",
    "duplicate_keys",
    "enrich",
    "in_open_window",
    "key_metrics",
    "latest",
    "require_rows",
    "row_counts",
    "top_k",
    "top_k_enriched",
    "top_k_counted",
    "upsert",
    "upsert_newest",
]
