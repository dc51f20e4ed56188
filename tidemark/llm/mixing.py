"""A mix of sources by target weights: hash-random order, distributed prefix sums, exact cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, take, written
from tidemark.session import scratch_path

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
ROWS_PER_BUCKET = 4096


def word_count(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS,
    seed: str = "mix", carry: tuple[str, ...] = (), rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Per row: doc_id, carried columns, size, source_size, target and taken (in words).

    Sources in order of code points, null last, get the weights in turn and share the words of
    all documents; a target stops at ``most_epochs`` times its source, and the excess goes to
    the others by weight. Each source's rows are put in the order of a hash of seed, doc_id and
    text; whole epochs are taken first, then rows from the start of that order, the last one in
    part, so that a source's taken words are its target without the fraction.

    The hash order is cut into buckets of about ``rows_per_bucket`` rows of all sources; sizes
    are summed per source and bucket before any shuffle, a running sum over those few rows gives
    each bucket its start, and rows are ordered within a bucket only. The largest source is
    spread over all buckets.

    A null text has size 0, and size 0 takes 0. Null doc_ids and repeated rows count as rows of
    their own; wholly equal rows are interchangeable. An empty table gives no rows.
    """
    mixed = _mix(docs, weights, most_epochs, seed, carry, rows_per_bucket)
    return mixed.withColumnsRenamed({f"k{i}": name for i, name in enumerate(carry)})


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS,
    seed: str = "mix", carry: tuple[str, ...] = (), rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """What ``mix`` takes, as documents: doc_id, text and the carried columns.

    A document has a row per epoch; the last may be its first words only, joined by one space.
    Documents that the mix does not take have no row.
    """
    mixed = _mix(docs, weights, most_epochs, seed, (*carry, "text"), rows_per_bucket)
    text = f"k{len(carry)}"
    rest = (F.col("taken") % F.col("size")).cast("int")
    words = F.slice(F.regexp_extract_all(text, F.lit(WORD), 0), F.lit(1), rest)
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    taken = mixed.filter("taken > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    partial = F.col("copy") * F.col("size") > F.col("taken")
    return taken.select(
        "doc_id",
        F.when(partial, F.array_join(words, " ")).otherwise(F.col(text)).alias("text"),
        *[F.col(f"k{i}").alias(name) for i, name in enumerate(carry)],
    )


def _mix(docs, weights, most_epochs, seed, carry, rows_per_bucket) -> DataFrame:
    """As ``mix``, with the carried columns still called k0, k1, ..."""
    plain = take(docs, *dict.fromkeys(["doc_id", "text", "source", *carry]))
    buckets = max(1, -(-docs.count() // rows_per_bucket))
    text = F.coalesce("text", F.lit(""))
    key = F.md5(F.concat_ws(
        ":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text)
    ))
    lead = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    keyed = plain.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.col(n).alias(f"k{i}") for i, n in enumerate(carry)],
        F.coalesce("source", F.lit("")).alias("s"),
        F.col("source").isNull().alias("s_null"),
        word_count().alias("size"),
        key.alias("key"),
        F.floor(lead * F.lit(buckets) / F.lit(1 << 32)).alias("bucket"),
    )
    parts = written(
        keyed.groupBy("s_null", "s", "bucket").agg(F.sum("size").alias("part_size")), "mix"
    )
    sources = _targets(parts, weights, most_epochs)
    before = Window.partitionBy("s_null", "s").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = parts.select(
        "s_null", "s", "bucket",
        F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("part_start"),
    ).join(sources, ["s_null", "s"])
    order = Window.partitionBy("s_null", "s", "bucket").orderBy("key", "doc_id", "size")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    start = F.col("part_start") + F.coalesce(
        F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    rest = budget - F.col("epochs") * F.col("source_size") - F.col("start")
    return (
        keyed.join(starts, ["s_null", "s", "bucket"])
        .withColumn("start", start)
        .withColumn("epochs", epochs)
        .select(
            "doc_id", *[f"k{i}" for i in range(len(carry))],
            "size", "source_size", "target",
            (F.col("epochs") * F.col("size") + F.greatest(
                F.lit(0), F.least(F.col("size"), rest)
            )).cast("long").alias("taken"),
        )
    )


def _targets(parts: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """s_null, s, source_size and target of every source; only totals reach the driver."""
    sized = parts.groupBy("s_null", "s").agg(F.sum("part_size").alias("source_size"))
    place = F.pmod(F.col("place"), F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int"))
    sources = _placed(sized, "s_null", "s").withColumn("weight", weight)
    total, share = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = total / share if share else 0.0
    while True:
        full = F.lit(level) * F.col("weight") > most * F.col("source_size")
        capped, rest = sources.agg(
            F.sum(F.when(full, F.col("source_size")).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))),
        ).first()
        raised = (total - most * capped) / rest if rest else level
        if raised == level:
            break
        level = raised
    target = F.least(F.lit(level) * F.col("weight"), (most * F.col("source_size")).cast("double"))
    return sources.select("s_null", "s", "source_size", target.alias("target"))


def _placed(df: DataFrame, *order: str) -> DataFrame:
    """The rows with their place (from 0) in the order, without a task that sees all of them.

    The sorted rows are checkpointed, so that numbers within partitions stay as they are; the
    only window without a key runs over one row per partition.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(df.sparkSession, "checkpoint"))
    fixed = df.orderBy(*order).checkpoint().select("*", F.monotonically_increasing_id().alias("n"))
    split = fixed.withColumn("p", F.shiftright("n", 33)).withColumn(
        "n", F.col("n").bitwiseAND((1 << 33) - 1)
    )
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    starts = split.groupBy("p").count().select(
        "p", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead")
    )
    return split.join(starts, "p").withColumn("place", F.col("ahead") + F.col("n")).drop(
        "p", "n", "ahead"
    )
