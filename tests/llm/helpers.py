"""Small tables with every awkward case, and helpers shared by the tests of this folder."""

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"w{i % 997}x{i // 997}" for i in range(30_000))
SHARED = " ".join(f"shared{i}" for i in range(40))
ROWS = [
    (1, "one two three four five six " + SHARED + " tail of the first", "en", "a", 10),
    (2, "other words before it\n" + SHARED + "\nand other words after it", "en", "b", 10),
    (3, None, "en", None, None),
    (4, "", None, "a", 0),
    (5, "   \t\n ", "en", "b", 5),
    (6, "short", "en", "é", 5),
    (7, LONG, "en", "a", 100),
    (8, LONG + " end", "en", "a", 100),
    (9, "Größe öffnet Ärger \U0001f600 \U0001f600 ok", "de", "b", 10),
    (9, "Größe öffnet Ärger \U0001f600 \U0001f600 ok", "de", "b", 10),
    (10, "aaa bbb ccc", "en", "a", 11),
    (11, "AAA bbb\tccc", "en", "a", 11),
    (None, SHARED, "en", "b", 10),
    (None, "aaa bbb ccc", "en", None, 11),
]


def small(spark):
    """The rows with extra columns whose names clash with those the operators use."""
    df = spark.createDataFrame(ROWS, SCHEMA)
    extra = ["batch", "k0", "fp", "size", "score", "DOC_ID", "Text", "part", "key", "bucket"]
    return df.selectExpr("*", *[f"'x' AS `{name}`" for name in extra])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sample(spark, name="documents"):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def words(text):
    """Maximal runs of characters other than space and tab to carriage return."""
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def key(row):
    return tuple((v is None, str(v)) for v in row)
