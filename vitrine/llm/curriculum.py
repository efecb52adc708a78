"""Mixing sources to target weights along a time-varying curriculum.

Targets share the whole size among the sources by weight; none exceeds ``most`` times its source,
and the excess goes to the others by weight (one pass over the sources ordered by how soon they
are full).  A source's documents stand in a fixed random order, and the mix takes whole passes
over them and a last part of a pass, so that the words taken are the target, rounded.

Every source has a weight schedule over training time 0..1, piecewise linear between knots.  Its
integral, scaled to the target, is the cumulative demand; inverting it at the middle of each taken
piece of the source's stream gives that piece's training position.  ``training_order`` sorts the
taken pieces by position over ranges, so no task sees more than its range.

Running sums are taken in two steps: sums of (source, bucket of the random order), a running sum
over the buckets of a source, and one inside each bucket; a source with a third of all rows is
spread over all its buckets.

Null texts have size 0; a null source is a source of its own, last in order; documents of size 0
are taken 0 times.  Rows with equal ids stand side by side in the order, by size and text, and count each; rows without an id
are ordered by their texts; an empty table gives an empty result.  All other columns are carried along whatever their
names; only those named like the ones that are added are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import word_count
from vitrine.session import materialize

WEIGHTS = (1, 2, 3)
MOST = 3
#: hexadecimal digits of the order's hash that make a bucket: 4,096 buckets of every source
DIGITS = 3
#: how far the default schedule leans: sources that are taken more often than the mean come later
LEAN = 0.5

KEY = ["mix_source", "mix_none"]


#: what the operator adds; columns of these names in the table are replaced
OUT = ("mix_order", "mix_size", "mix_total", "mix_target", "mix_taken", "mix_passes")


def _keys(docs: DataFrame, doc_id: str, source: str, text: str, size: Column, digits: int, carry: list[str]) -> DataFrame:
    """Rows as one struct (mix_row), so that no name of theirs meets one used here, with source key, place in the random order, bucket and size.

    Rows without an id are spread by their texts; ties go by size, then by the text's hash.
    """
    body = F.col(text).cast("string") if text in docs.columns else F.lit("")
    order = F.md5(F.coalesce(F.col(doc_id).cast("string"), body, F.lit("")).cast("binary"))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("mix_row"), F.col(doc_id).cast("string").alias("mix_id"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("mix_source"), F.col(source).isNull().alias("mix_none"),
        order.alias("mix_order"), F.substring(order, 1, digits).alias("mix_bucket"), size.alias("mix_size"), F.xxhash64(body).alias("mix_tie"),
    )


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds mix_target to one row per source (mix_source, mix_none, mix_total). Windows here see one row per source."""
    by_name = Window.orderBy("mix_none", "mix_source")
    everything = Window.partitionBy()
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = totals.withColumn("w", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("mix_total") * most).withColumn("full_at", F.col("cap") / F.col("w"))
    by_full = Window.orderBy("full_at", "mix_none", "mix_source")
    level = (F.sum("mix_total").over(everything) - F.sum("cap").over(by_full.rowsBetween(Window.unboundedPreceding, 0)) + F.col("cap")) / (
        F.sum("w").over(by_full.rowsBetween(0, Window.unboundedFollowing)))
    return (
        ranked.withColumn("level", level).withColumn("level", F.max("level").over(everything))
        .withColumn("mix_target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")))
        .select(*KEY, "mix_total", "mix_target")
    )


def leaning(sources: DataFrame, lean: float = LEAN) -> DataFrame:
    """The default schedule: (mix_source, mix_none, knots), two knots per source.

    A source's lean is the distance of its repeat rate from the mean rate, over the largest such distance;
    weighted by target the distances add up to nothing, so the shares add up to one at every time.
    """
    everything = Window.partitionBy()
    rate = F.when(F.col("mix_total") > 0, F.col("mix_target") / F.col("mix_total")).otherwise(F.lit(0.0))
    mean = F.sum(F.col("rate") * F.col("mix_target")).over(everything) / F.sum("mix_target").over(everything)
    rows = sources.withColumn("rate", rate).withColumn("off", F.col("rate") - F.coalesce(mean, F.lit(0.0)))
    widest = F.max(F.abs("off")).over(everything)
    tilt = F.when(widest > 0, F.lit(lean) * F.col("off") / widest).otherwise(F.lit(0.0))
    return rows.withColumn("tilt", tilt).select(
        *KEY,
        F.array(
            F.struct(F.lit(0.0).alias("t"), (1 - F.col("tilt")).alias("w")), F.struct(F.lit(1.0).alias("t"), (1 + F.col("tilt")).alias("w")),
        ).alias("knots"),
    )


def _demand(knots: Column) -> Column:
    """Integral of a schedule up to each knot."""
    areas = F.transform(F.sequence(F.lit(1), F.size(knots) - 1), lambda i: (
        (F.get(knots, i)["t"] - F.get(knots, i - 1)["t"]) * (F.get(knots, i)["w"] + F.get(knots, i - 1)["w"]) / 2))
    return F.aggregate(areas, F.array(F.lit(0.0)), lambda done, a: F.concat(done, F.array(F.element_at(done, -1) + a)))


def position(knots: Column, demand: Column, share: Column) -> Column:
    """Training time at which a share (0..1) of a schedule's integral is reached."""
    y = share * F.element_at(demand, -1)
    i = F.least(F.greatest(F.size(F.filter(demand, lambda d: d <= y)), F.lit(1)), F.size(demand) - 1)
    left, right = F.get(knots, i - 1), F.get(knots, i)
    rest, width = y - F.get(demand, i - 1), right["t"] - left["t"]
    root = F.sqrt(F.greatest(left["w"] * left["w"] + 2 * rest * (right["w"] - left["w"]) / width, F.lit(0.0)))
    return F.least(left["t"] + F.when(left["w"] + root > 0, 2 * rest / (left["w"] + root)).otherwise(F.lit(0.0)), F.lit(1.0))


def assign(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", size: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST, schedule: DataFrame | None = None, digits: int = DIGITS, lean: float = LEAN,
    carry: list[str] | None = None,
) -> DataFrame:
    """The rows with mix_size, mix_total, mix_target, mix_taken and mix_passes (array of taken, position) added.

    ``carry`` names the columns to keep (all, if not given); others, such as a text that is only counted, are not moved.
    ``schedule`` has (source, knots array<struct<t, w>>), knots from t = 0 to 1; sources it lacks lean as by default.
    """
    size = word_count(F.col(text)) if size is None else size
    rows = _keys(docs, doc_id, source, text, size, digits, docs.columns if carry is None else carry)
    buckets = materialize(rows.groupBy(*KEY, "mix_bucket").agg(F.sum("mix_size").alias("bucket_size")), "mix-buckets")
    sources = targets(buckets.groupBy(*KEY).agg(F.sum("bucket_size").alias("mix_total")), weights, most)
    knots = leaning(sources, lean)
    if schedule is not None:
        own = schedule.select(
            F.coalesce("source", F.lit("")).alias("mix_source"), F.col("source").isNull().alias("mix_none"), F.col("knots").alias("own"))
        knots = knots.join(own, KEY, "left").select(*KEY, F.coalesce("own", "knots").alias("knots"))
    before = Window.partitionBy(*KEY).orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, 0)
    offsets = (
        buckets.withColumn("bucket_from", F.sum("bucket_size").over(before) - F.col("bucket_size")).drop("bucket_size")
        .join(sources, KEY).join(knots.withColumn("demand", _demand(F.col("knots"))), KEY)
    )
    inside = Window.partitionBy(*KEY, "mix_bucket").orderBy("mix_order", "mix_id", "mix_size", "mix_tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("mix_from", F.sum("mix_size").over(inside) - F.col("mix_size")).join(offsets, [*KEY, "mix_bucket"])
    placed = placed.withColumn("mix_from", F.col("mix_from") + F.col("bucket_from"))
    target = F.floor(F.col("mix_target") + 0.5)
    passes = F.array(*[
        F.struct(
            F.greatest(F.lit(0).cast("long"), F.least(F.col("mix_size"), target - p * F.col("mix_total") - F.col("mix_from"))).alias("taken"),
            (F.col("mix_from") + p * F.col("mix_total")).alias("at"),
        ) for p in range(most)
    ])
    placed = placed.withColumn("mix_passes", F.filter(passes, lambda x: x["taken"] > 0))
    return placed.withColumn("mix_passes", F.transform("mix_passes", lambda x: F.struct(
        x["taken"].alias("taken"),
        position(F.col("knots"), F.col("demand"), (x["at"] + x["taken"] / 2) / F.col("mix_target")).alias("position"),
    ))).withColumn("mix_taken", F.aggregate("mix_passes", F.lit(0).cast("long"), lambda n, x: n + x["taken"])).select(
        *[F.col(f"mix_row.`{c}`") for c in (docs.columns if carry is None else carry) if c not in OUT], *OUT)


def training_order(assigned: DataFrame) -> DataFrame:
    """One row per taken piece (mix_words of its document, whole or cut), sorted by mix_position over ranges."""
    own = [F.col(f"`{c}`") for c in assigned.columns if c not in ("mix_passes", "mix_words", "mix_position")]
    taken = assigned.select(*own, F.explode("mix_passes").alias("mix_pass")).select(
        *own, F.col("mix_pass.taken").alias("mix_words"), F.col("mix_pass.position").alias("mix_position"))
    return taken.repartitionByRange("mix_position", "mix_order").sortWithinPartitions("mix_position", "mix_order")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    # each word with the white space before it
    words = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++"), F.lit(0))
    return F.when(word_count(text) <= n, text).otherwise(F.array_join(F.slice(words, 1, n.cast("int")), ""))
