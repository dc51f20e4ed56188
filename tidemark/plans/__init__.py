from tidemark.plans.clean import clean_authors, clean_books, clean_reviews, clean_users
from tidemark.plans.lists import AUTHOR_LISTS, BOOK_LISTS, KeyLists
from tidemark.plans.quarantine import REJECTS, read_accepted
from tidemark.plans.refresh import (
    check_warehouse,
    process_raw,
    refresh,
    refresh_lists,
    refresh_warehouse,
)
from tidemark.plans.totals import DailyTotals, RepeatedKeys

__all__ = [
    "AUTHOR_LISTS",
    "BOOK_LISTS",
    "DailyTotals",
    "KeyLists",
    "REJECTS",
    "RepeatedKeys",
    "check_warehouse",
    "clean_authors",
    "clean_books",
    "clean_reviews",
    "clean_users",
    "process_raw",
    "read_accepted",
    "refresh",
    "refresh_lists",
    "refresh_warehouse",
]
