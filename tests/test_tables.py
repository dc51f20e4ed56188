"""Tables: creation, append, replacement, upsert, layout, failures, other sessions."""

import random
import re
import subprocess
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import latest
from tidemark.schemas import (
    ANALYTICS_TABLES,
    LONG,
    TEXT,
    TIME,
    WAREHOUSE_TABLES,
    TableSpec,
    struct,
)
from tidemark.sinks import BucketedTable, Database, merged_over_salts

PAIR = TableSpec("pair", struct(k=LONG, p=TEXT), key="k", distribute_on="k")
TIMED = TableSpec("timed", struct(k=LONG, t=TIME), key="k", sort_by="t")


@pytest.fixture
def database(spark, tmp_path):
    def make(parts=None):
        return Database(spark, f"d{uuid.uuid4().hex}", str(tmp_path), parts)

    return make


def pairs(spark, *rows):
    return spark.createDataFrame(rows, "k long, p string")


def content(db, table="pair"):
    return sorted((tuple(r) for r in db.read(table).collect()), key=repr)


def folders(db, table="pair"):
    return sorted(p.name for p in Path(f"{db.root}/{table}").iterdir() if p.is_dir())


def read_parts(df):
    """The parts whose files a DataFrame reads."""
    return {int(m) for m in re.findall(r"part=(\d+)", " ".join(df.inputFiles()))}


def part_of(spark, parts, *keys):
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    return {r[0] for r in rows.select(F.pmod(F.xxhash64("k"), F.lit(parts))).collect()}


def test_creation_is_idempotent(spark, database):
    db = database().create(PAIR)
    db.append("pair", pairs(spark, (1, "a")))
    db.create(PAIR)
    assert content(db) == [(1, "a")]


def test_all_declared_tables(spark, database):
    db = database().create(*WAREHOUSE_TABLES, *ANALYTICS_TABLES)
    for spec in (*WAREHOUSE_TABLES, *ANALYTICS_TABLES):
        assert db.read(spec.name).schema == spec.schema
    assert [len(s.columns) for s in ANALYTICS_TABLES] == [9, 9, 10, 15, 15, 16]
    db.drop("users", "users", "never_there")
    assert not db.exists("users") and not db.exists("never_there") and db.exists("books")
    with pytest.raises(ValueError, match="no table"):
        db.read("users")
    db.create(*WAREHOUSE_TABLES)
    assert db.read("users").isEmpty()


def test_another_schema_is_refused(spark, database):
    db = database().create(PAIR)
    db.append("pair", pairs(spark, (1, "a")))
    for other in (struct(k=LONG, p=LONG), struct(k=LONG), struct(p=TEXT, k=LONG)):
        with pytest.raises(ValueError, match="another schema"):
            db.create(TableSpec("pair", other, key="k"))
    assert content(db) == [(1, "a")]


def test_any_object_and_session_sees_the_tables(spark, database, tmp_path):
    """Two processes upsert one root, one after the other; each reads both changes."""
    program = """if True:
        import sys
        from tidemark.session import build_session
        from tidemark.sinks import Database
        from tests.test_tables import PAIR
        spark = build_session("other", "local[1]", **{"spark.ui.enabled": "false"})
        db = Database(spark, "shared", sys.argv[1]).create(PAIR)
        db.upsert("pair", spark.createDataFrame([(int(sys.argv[2]), "d")], "k long, p string"))
        print("rows", sorted(tuple(r) for r in db.read("pair").collect()))
    """
    out = [
        subprocess.run([sys.executable, "-c", program, str(tmp_path), day], text=True,
                       capture_output=True, check=True, timeout=300,
                       cwd=Path(__file__).resolve().parents[1]).stdout
        for day in ("1", "2")
    ]
    assert "rows [(1, 'd')]" in out[0] and "rows [(1, 'd'), (2, 'd')]" in out[1]
    fresh = Database(spark, "shared", str(tmp_path))
    assert content(fresh) == [(1, "d"), (2, "d")]
    assert fresh.schema("pair") == PAIR.schema


def test_expiry_keeps_what_is_read(spark, database):
    db = database(4).create(PAIR)
    db.replace("pair", pairs(spark, (1, "a")))
    db.replace("pair", pairs(spark, *((i, "b") for i in range(40))))
    db.upsert("pair", pairs(spark, (2, "c"), (None, "n")))
    db.append("pair", pairs(spark, (2, "d")))
    before = content(db)
    assert db.expire("pair") == [] and content(db) == before
    gone = db.expire("pair", min_age_hours=-1)
    # The first content, and the part of the second that the upsert wrote anew.
    assert len(gone) == 2 and gone[0].startswith("replace-") and "/part=" in gone[1]
    assert content(db) == before
    assert db.expire("pair", min_age_hours=-1) == []
    db.compact("pair")
    assert content(db) == before and len(db.state("pair").changes) == 1
    assert len(db.expire("pair", min_age_hours=-1)) == 3 and content(db) == before
    db.compact("pair")
    assert len(folders(db)) == 1


# ---------------------------------------------------------------- failures and repeats


CHANGES = {
    "replace": [(7, "r"), (None, "r")],
    "append": [(2, "again"), (None, "n")],
    "upsert": [(2, "u"), (9, "u"), (None, "u")],
}


def loaded(spark, db):
    db.create(PAIR)
    db.replace("pair", pairs(spark, (1, "a"), (2, "b"), (None, "n"), (None, "n")))
    db.upsert("pair", pairs(spark, (2, "x"), (3, "y"), (None, "m")))
    return db


@pytest.mark.parametrize("parts", [0, 1, 4])
@pytest.mark.parametrize("change", list(CHANGES))
def test_a_failed_change_leaves_the_old_rows(spark, database, change, parts):
    """It fails while rows are written, or before the end is noted; then it is repeated."""
    whole, batch = loaded(spark, database(parts)), pairs(spark, *CHANGES[change])
    old = content(whole)
    getattr(whole, change)("pair", batch)
    new = content(whole)
    db = loaded(spark, database(parts))
    assert content(db) == old
    broken = F.when(F.col("p").isin("r", "again", "u"), F.raise_error(F.lit("half way")))
    with pytest.raises(Exception, match="half way"):
        getattr(db, change)("pair", batch.withColumn("p", broken.otherwise(F.col("p"))))
    assert content(db) == old
    getattr(db, change)("pair", batch, "day")
    (done,) = Path(f"{db.root}/pair").glob("*-day/_SUCCESS")
    done.unlink()
    fresh = Database(spark, db.name, db.root.rsplit("/", 1)[0], parts)
    assert content(fresh) == old
    getattr(fresh, change)("pair", batch, "day")
    assert content(fresh) == new


@pytest.mark.parametrize("parts", [0, 4])
@pytest.mark.parametrize("change", list(CHANGES))
def test_a_change_with_an_id_is_done_once(spark, database, change, parts):
    db = loaded(spark, database(parts))
    batch = pairs(spark, *CHANGES[change])
    getattr(db, change)("pair", batch, "run-1")
    new, before = content(db), folders(db)
    getattr(db, change)("pair", batch, "run-1")
    assert content(db) == new and folders(db) == before
    getattr(db, change)("pair", batch, "run-2")
    assert len(folders(db)) == len(before) + 1


def test_ids_name_folders(spark, database):
    db = database().create(PAIR)
    with pytest.raises(ValueError, match="id"):
        db.replace("pair", pairs(spark, (1, "a")), change="../away")


def test_append_is_by_position_and_does_not_replace(spark, database):
    db = database().create(PAIR)
    for _ in range(2):
        db.append("pair", spark.createDataFrame([(1, "a")], "p long, k string"))
    assert content(db) == [(1, "a"), (1, "a")]


def test_replace_is_by_name(spark, database):
    db = database().create(PAIR)
    db.append("pair", pairs(spark, (1, "a")))
    db.replace("pair", spark.createDataFrame([("b", 2)], "p string, k int"))
    assert content(db) == [(2, "b")]
    with pytest.raises(ValueError, match="surplus"):
        db.replace("pair", pairs(spark, (3, "c")).withColumn("q", F.lit(1)))
    assert content(db) == [(2, "b")]


def test_table_may_be_computed_from_itself(spark, database):
    db = database().create(PAIR)
    db.replace("pair", pairs(spark, (1, "a"), (2, "b")))
    db.replace("pair", db.read("pair").where("k = 2"))
    assert content(db) == [(2, "b")]


def test_failed_replacement_leaves_the_table_as_it_was(spark, database):
    db = database().create(PAIR)
    db.replace("pair", pairs(spark, (1, "a")))
    broken = pairs(spark, (2, "b")).withColumn("p", F.raise_error(F.lit("half way")))
    with pytest.raises(Exception, match="half way"):
        db.replace("pair", broken)
    assert content(db) == [(1, "a")]


def test_a_reader_keeps_the_content_it_started_with(spark, database):
    db = database().create(PAIR)
    db.replace("pair", pairs(spark, (1, "a")))
    before = db.read("pair")
    before.count()
    folder = before.inputFiles()[0]
    db.replace("pair", pairs(spark, (2, "b")))
    assert Path(folder.removeprefix("file://")).exists()


def test_upsert_on_tables(spark, database):
    db = database().create(PAIR)
    db.replace("pair", pairs(spark, (1, "a"), (2, "b"), (None, "n")))
    for _ in range(2):
        db.upsert("pair", pairs(spark, (2, "x"), (3, "y")))
    assert content(db) == [(1, "a"), (2, "x"), (3, "y"), (None, "n")]


# ---------------------------------------------------------------- parts


def test_an_upsert_reads_and_writes_only_the_parts_of_its_keys(spark, database):
    db = database(16).create(PAIR)
    rows = spark.range(500).select(F.col("id").alias("k"), F.lit("p").alias("p"))
    db.replace("pair", rows)
    touched = part_of(spark, 16, 3, 700)
    assert len(touched) < 16
    seen = []
    load = db._load
    db._load = lambda spec, names: seen.append(load(spec, names)) or seen[-1]
    db.upsert("pair", pairs(spark, (3, "x"), (700, "y"), (None, "n")), change="few")
    (target,) = seen
    assert read_parts(target) == touched & part_of(spark, 16, *range(500))
    (folder,) = Path(f"{db.root}/pair").glob("upsert-*")
    assert {p.name for p in folder.glob("part=*")} == {
        *(f"part={p}" for p in touched), "part=__HIVE_DEFAULT_PARTITION__"
    }
    db._load = load
    want = {(k, "p") for k in range(500) if k != 3} | {(3, "x"), (700, "y"), (None, "n")}
    assert set(content(db)) == want and db.read("pair").count() == 502
    assert read_parts(db.read("pair", change="few")) == touched


def test_any_sequence_of_changes_gives_the_same_in_parts_or_whole(spark, database):
    choose = random.Random(3)
    changes = []
    for _ in range(9):
        batch = [(choose.choice([*range(9), None]), choose.choice("uvw"))
                 for _ in range(choose.randint(0, 4))]
        changes.append((choose.choice(["upsert", "upsert", "append", "replace"]), batch))
    made = []
    for parts in (0, 1, 5):
        db = database(parts).create(PAIR)
        for change, batch in changes:
            getattr(db, change)("pair", pairs(spark, *batch))
        made.append(content(db))
    assert made[0] == made[1] == made[2]


def test_a_hot_part_is_several_files(spark, database):
    db = database(4).create(PAIR)
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("p"),
    )
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
                "spark.sql.shuffle.partitions": "4"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        db.replace("pair", rows)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    (hot,) = part_of(spark, 4, 1)
    files = [f for f in db.read("pair").inputFiles() if f"part={hot}/" in f]
    assert len(files) > 1
    most = max(spark.read.parquet(f).count() for f in files)
    assert most < 13_000 and db.read("pair").count() == 40_000


def test_the_newest_row_of_a_key_stays(spark, database):
    db = database(3).create(TIMED)
    days = [[(1, "2020-01-02"), (2, "2020-01-05"), (3, None)], [(1, "2020-01-01"), (4, "2020-01-01")],
            [(1, "2020-01-03"), (1, "2020-01-03"), (2, "2020-01-04"), (3, "2020-01-01")]]

    def rows(*days):
        return spark.createDataFrame([r for d in days for r in d], "k long, t string").select(
            "k", F.col("t").cast("timestamp_ntz")
        )

    for day in days:
        db.upsert("timed", rows(day), newest="t")
    got = sorted((r.k, str(r.t)[:10]) for r in db.read("timed").collect())
    assert got == [(1, "2020-01-03"), (1, "2020-01-03"), (2, "2020-01-05"), (3, "2020-01-01"),
                   (4, "2020-01-01")]
    assert sorted(map(str, latest(rows(*days), ["k"], "t").collect())) == sorted(
        map(str, db.read("timed").collect()))


def test_only_few_outdated_keys_are_broadcast(spark, database, monkeypatch):
    db = database(3).create(TIMED)
    rows = spark.range(3_000).selectExpr("id AS k", "timestamp_ntz '2020-01-02' AS t")
    older = rows.withColumn("t", F.expr("timestamp_ntz '2020-01-01'"))
    spec = db.spec("timed")
    for most, join in ((2_999, "SortMergeJoin"), (3_000, "BroadcastHashJoin")):
        monkeypatch.setattr("tidemark.sinks.tables.BROADCAST_KEYS", most)
        with db._merged(spec, rows, older, "t") as got:
            assert len(got.collect()) == 3_000
            ran = got._jdf.queryExecution().executedPlan().toString()
            assert join in ran.partition("Initial Plan")[0]


def test_rows_around_a_change(spark, database):
    db = database(4).create(PAIR)
    db.replace("pair", pairs(spark, *((k, "a") for k in range(20))), change="load")
    before, after = db.around("pair", "load")
    assert before.isEmpty() and after.count() == 20 and db.is_whole("pair", "load")
    db.upsert("pair", pairs(spark, (3, "b"), (None, "n")), change="one")
    db.upsert("pair", pairs(spark, (3, "c"), (None, "o")), change="two")
    for change, old, new, key in (("one", "a", "b", "n"), ("two", "b", "c", "o")):
        sides = [sorted(map(tuple, side.collect()), key=repr) for side in db.around("pair", change)]
        assert (3, old) in sides[0] and (3, new) in sides[1]
        assert (None, key) in sides[1] and (None, key) not in sides[0]
        rest = [[r for r in side if r[0] not in (3, None)] for side in sides]
        assert rest[0] == rest[1] and 0 < len(rest[0]) < 19
        assert not db.is_whole("pair", change)
    with pytest.raises(ValueError, match="no change"):
        db.around("pair", "three")


def test_the_number_of_parts_follows_the_size(spark, database, monkeypatch):
    db = database().create(PAIR)
    rows = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("p"))
    db.replace("pair", rows.toDF("k", "p"))
    monkeypatch.setattr("tidemark.sinks.tables.PART_BYTES", 100_000)
    db.replace("pair", rows.toDF("k", "p"))
    assert db.state("pair").parts > 5
    assert db.read("pair").count() == 20_000
    db.upsert("pair", pairs(spark, (1, "x")))
    assert db.state("pair").parts > 5 and db.read("pair").count() == 20_000


def test_rows_are_sorted_by_time_within_a_file(spark, database):
    db = database().create(TIMED)
    rows = spark.range(1000).select(
        F.col("id").alias("k"),
        F.timestamp_seconds(F.pmod(F.hash("id"), F.lit(10**9))).cast("timestamp_ntz").alias("t"),
    )
    db.replace("timed", rows)
    spans = []
    for file in db.read("timed").inputFiles():
        times = [r.t for r in spark.read.parquet(file).collect()]
        assert times == sorted(times)
        spans.append((times[0], times[-1]))
    # Files hold ranges that do not overlap, so a window opens few of them.
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert db.read("timed").count() == 1000


def test_a_window_skips_files(spark, database):
    db = database().create(TIMED)
    rows = spark.range(20_000).select(
        F.col("id").alias("k"),
        F.timestamp_seconds(F.pmod(F.hash("id"), F.lit(10**9))).cast("timestamp_ntz").alias("t"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        db.replace("timed", rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    low, high = "1990-01-01 00:00:00", "1990-02-01 00:00:00"
    window = f"t > timestamp_ntz '{low}' and t < timestamp_ntz '{high}'"
    assert len(db.read("timed").inputFiles()) == 4
    # Row groups are skipped by their statistics: what the scan hands on is of few files.
    scanned = db.read("timed").where(window)
    plan = scanned._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [IsNotNull(t), GreaterThan(t" in plan.toString()
    kept = scanned.select("_metadata.file_path").distinct().count()
    expected = rows.where(window).count()
    assert scanned.count() == expected > 0 and kept <= 2


def test_a_window_skips_pages_of_a_part(spark, database):
    db = database(2).create(TIMED)
    rows = spark.range(20_000).select(
        F.col("id").alias("k"),
        F.timestamp_seconds(F.pmod(F.hash("id"), F.lit(10**9))).cast("timestamp_ntz").alias("t"),
    )
    db.replace("timed", rows)
    for file in db.read("timed").inputFiles():
        times = [r.t for r in spark.read.parquet(file).collect()]
        assert times == sorted(times)


def test_emptiness(spark, database):
    db = database().create(PAIR)
    assert db.is_empty("pair")
    db.replace("pair", pairs(spark, (1, "a")).where("false"))
    assert db.is_empty("pair")
    db.upsert("pair", pairs(spark, (1, "a")))
    assert not db.is_empty("pair")


# ---------------------------------------------------------------- buckets


def orders(spark, hot):
    key = F.when(F.col("id") % 3 == 0, F.lit(1)) if hot else F.when(F.lit(False), F.lit(1))
    return spark.range(6000).select(
        key.otherwise(F.when(F.col("id") % 50 != 7, F.col("id") % 500)).alias("k"), "id"
    )


COUNTS = ({"n": F.count, "last": F.max}, {"n": F.sum, "last": F.max})


def merged(table):
    partial, merge = ({n: f(c) for (n, f), c in zip(fs.items(), cs)}
                      for fs, cs in zip(COUNTS, (("id", "id"), ("n", "last"))))
    return merged_over_salts(table, "k", partial, merge)


@pytest.mark.parametrize("hot", [False, True])
def test_buckets_with_a_hot_value(spark, tmp_path, hot):
    rows = orders(spark, hot)
    table = BucketedTable(spark, str(tmp_path / "b"))
    heavy = table.write(rows, "k", buckets=8, salts=5, sort_by="id")
    assert heavy == ([1] if hot else [])
    read = BucketedTable(spark, str(tmp_path / "b")).read()
    got = merged(read)
    want = rows.groupBy("k").agg(F.count("id").alias("n"), F.max("id").alias("last"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    # One exchange, of the partial rows of the hot value.
    plan = merged(read)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    light = merged(read.where("salt = 0"))
    sizes = [r["count"] for r in read.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert max(sizes) < 6000 / 3 and light.count() >= want.count() - 1


def test_a_bucketed_table_has_a_salt_of_its_own(spark, tmp_path):
    with pytest.raises(ValueError, match="salt"):
        BucketedTable(spark, str(tmp_path / "b")).write(spark.range(3).toDF("salt"), "salt")
