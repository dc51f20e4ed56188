"""Every table of the warehouse: columns, key, raw file and layout.

TIMESTAMP columns carry no zone, so they are ``timestamp_ntz``: the wall-clock value is
stored and compared as it is, whatever the session zone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

LONG, INT, SHORT, DOUBLE = LongType(), IntegerType(), ShortType(), DoubleType()
BOOL, TEXT, TIME = BooleanType(), StringType(), TimestampNTZType()


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: StructType
    key: str
    # Layout: the column whose equal values should lie together; None spreads rows evenly.
    distribute_on: str | None = None
    # Rows are sorted by this column within a file, so a range of it skips row groups.
    sort_by: str | None = None
    # Raw file: base name, escape character, columns that are still text there.
    raw_name: str | None = None
    raw_escape: str = '"'
    raw_text: tuple[str, ...] = field(default=())
    # Columns that the pick-up adds, which the raw file does not have.
    added: tuple[str, ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def raw_schema(self) -> StructType:
        return StructType([
            StructField(f.name, TEXT if f.name in self.raw_text else f.dataType)
            for f in self.schema if f.name not in self.added
        ])


def struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


VERSION = "record_create_timestamp"

# Columns, order and types of the tables a user of the warehouse queries.
AUTHOR_ATTRIBUTES = dict(
    name=TEXT, role=TEXT, profile_url=TEXT, average_rating=DOUBLE, rating_count=INT,
    text_review_count=INT, record_create_timestamp=TIME,
)
BOOK_ATTRIBUTES = dict(
    title=TEXT, title_without_series=TEXT, image_url=TEXT, book_url=TEXT, num_pages=INT,
    format=TEXT, edition_information=TEXT, publisher=TEXT, average_rating=DOUBLE,
    ratings_count=INT, description=TEXT, authors=LONG, record_create_timestamp=TIME,
)

AUTHORS = TableSpec(
    "authors",
    struct(author_id=LONG, **AUTHOR_ATTRIBUTES),
    key="author_id",
    distribute_on="author_id",
    raw_name="author",
    raw_escape="\\",
)
REVIEWS = TableSpec(
    "reviews",
    struct(
        review_id=LONG, user_id=LONG, book_id=LONG, author_id=LONG, review_text=TEXT,
        review_rating=DOUBLE, review_votes=INT, spoiler_flag=BOOL, spoiler_state=TEXT,
        review_added_date=TIME, review_updated_date=TIME, review_read_count=INT,
        comments_count=INT, review_url=TEXT, record_create_timestamp=TIME,
    ),
    key="review_id",
    distribute_on="author_id",
    sort_by=VERSION,
    raw_name="reviews",
    raw_text=("review_added_date", "review_updated_date"),
)
BOOKS = TableSpec(
    "books",
    struct(
        book_id=LONG, title=TEXT, title_without_series=TEXT, image_url=TEXT, book_url=TEXT,
        num_pages=INT, format=TEXT, edition_information=TEXT, publisher=TEXT,
        publication_day=SHORT, publication_year=SHORT, publication_month=SHORT,
        average_rating=DOUBLE, ratings_count=INT, description=TEXT, authors=LONG,
        published=SHORT, record_create_timestamp=TIME,
    ),
    key="book_id",
    raw_name="book",
)
USERS = TableSpec(
    "users",
    struct(
        user_id=LONG, user_name=TEXT, user_display_name=TEXT, location=TEXT, profile_link=TEXT,
        uri=TEXT, user_image_url=TEXT, small_image_url=TEXT, has_image=BOOL,
        record_create_timestamp=TIME,
    ),
    key="user_id",
    raw_name="user",
)
WAREHOUSE_TABLES = (AUTHORS, REVIEWS, BOOKS, USERS)

POPULAR_AUTHORS_COUNT = TableSpec(
    "popular_authors_review_count",
    struct(author_id=LONG, review_count=LONG, **AUTHOR_ATTRIBUTES),
    key="author_id",
    distribute_on="author_id",
)
POPULAR_AUTHORS_RATING = TableSpec(
    "popular_authors_average_rating",
    struct(author_id=LONG, average_review_rating=DOUBLE, **AUTHOR_ATTRIBUTES),
    key="author_id",
    distribute_on="author_id",
)
BEST_AUTHORS = TableSpec(
    "best_authors",
    struct(
        author_id=LONG, review_count=LONG, average_review_rating=DOUBLE, **AUTHOR_ATTRIBUTES,
    ),
    key="author_id",
    distribute_on="author_id",
)
POPULAR_BOOKS_COUNT = TableSpec(
    "popular_books_review_count",
    struct(book_id=LONG, review_count=LONG, **BOOK_ATTRIBUTES),
    key="book_id",
)
POPULAR_BOOKS_RATING = TableSpec(
    "popular_books_average_rating",
    struct(book_id=LONG, average_reviews_rating=DOUBLE, **BOOK_ATTRIBUTES),
    key="book_id",
)
BEST_BOOKS = TableSpec(
    "best_books",
    struct(
        book_id=LONG, average_reviews_rating=DOUBLE, review_count=LONG, **BOOK_ATTRIBUTES,
    ),
    key="book_id",
)
# The declared type of the average in the "best books" table is an integer one. Keeping the
# fraction is the default; this variant holds the half-even rounded value instead.
BEST_BOOKS_INTEGER = TableSpec(
    "best_books",
    struct(
        book_id=LONG, average_reviews_rating=LONG, review_count=LONG, **BOOK_ATTRIBUTES,
    ),
    key="book_id",
)
ANALYTICS_TABLES = (
    POPULAR_AUTHORS_COUNT,
    POPULAR_AUTHORS_RATING,
    BEST_AUTHORS,
    POPULAR_BOOKS_COUNT,
    POPULAR_BOOKS_RATING,
    BEST_BOOKS,
)
