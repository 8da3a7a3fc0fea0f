"""Mixing sources to target weights with a low-discrepancy schedule.

A source is a stream of its documents in shuffled order, repeated up to ``MAX_EPOCHS`` times and
cut into blocks of equally many words. The schedule maps the points of the golden-ratio sequence
through the cumulative target shares: slot ``n`` belongs to the source whose interval holds its
point, and the ``r``-th slot of a source takes its block ``r``. A source ends at its target, so
its last block is cut there; slots beyond it fall away, and where the sequence gives a source a
few slots too few, they follow at the end of the schedule.

No step gathers a source: places in a stream come from sums per bucket of the shuffle order, ranks
of slots from counts per chunk of the schedule. Only per-source totals are ordered as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanflux.llm.common import WORD
from urbanflux.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
BLOCK_WORDS = 1024
#: Cells of [0, 1) by which points meet the intervals of sources.
CELLS = 65_536
#: Slots whose ranks are counted together.
CHUNK = 65_536
#: Hexadecimal digits of the shuffle order by which a source is summed up.
BUCKET_DIGITS = 3
GOLDEN = 0.6180339887498949


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` (words) to ``(source_key, source, source_size)``, a row per source.

    Weights repeat over the sources by code point, null last. The total is shared by weight; what a
    source would get beyond ``epochs`` times its size goes to the others by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights)).cast("int") + 1)
    by_ratio = Window.orderBy("ratio", "source_key")
    everything = Window.partitionBy()
    out = totals.withColumn("weight", weight).withColumn("cap", F.lit(epochs) * F.col("source_size"))
    out = out.withColumn("ratio", F.col("cap") / F.col("weight"))
    capped = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    out = out.withColumn("level", (F.sum("source_size").over(everything) - capped) / rest)
    out = out.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source_key", "level"))).over(everything)["level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level"), F.col("ratio")) * F.col("weight"))
    return out.withColumn("target", target).select("source_key", "source", "source_size", "target")


def schedule(plan: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Slots ``(slot, source_key, rank)`` for ``(source_key, target)``, a row per source.

    Slots are in the order of training; a source gets exactly the blocks that hold its target.
    """
    spark = plan.sparkSession
    total = Window.partitionBy()
    upper = F.sum("target").over(Window.orderBy("source_key"))
    shares = plan.where("target > 0").select(
        "source_key",
        F.ceil(F.round("target") / block_words).cast("long").alias("quota"),
        ((upper - F.col("target")) / F.sum("target").over(total)).alias("lower"),
        (upper / F.sum("target").over(total)).alias("upper"),
    )
    shares = materialize(shares, "mix-shares")
    n = shares.agg(F.coalesce(F.sum("quota"), F.lit(0)).alias("n")).first()["n"]
    cells = shares.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("lower") * CELLS), F.least(F.floor(F.col("upper") * CELLS), F.lit(CELLS - 1)).cast("long")))
    )
    point = F.pmod((F.col("id") + 0.5) * GOLDEN, F.lit(1.0))
    points = spark.range(n).select(F.col("id").alias("slot"), point.alias("point"), F.floor(point * CELLS).alias("cell"))
    slots = points.join(cells, "cell").where("lower <= point AND point < upper").select("slot", "source_key", "quota", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    counts = materialize(slots.groupBy("source_key", "chunk").agg(F.count("*").alias("n")), "mix-slots")
    before = F.sum("n").over(Window.partitionBy("source_key").orderBy("chunk")) - F.col("n")
    starts = counts.select("source_key", "chunk", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("source_key", "chunk").orderBy("slot")) - 1
    ranked = slots.join(starts, ["source_key", "chunk"]).select("slot", "source_key", "quota", (F.col("before") + place).alias("rank"))
    given = counts.groupBy("source_key").agg(F.sum("n").alias("given"))
    missing = shares.join(given, "source_key", "left").withColumn("given", F.coalesce("given", F.lit(0))).where("given < quota")
    late = missing.select("source_key", "quota", F.explode(F.sequence(F.col("given"), F.col("quota") - 1)).alias("rank"))
    late = late.select((F.col("rank") + n).alias("slot"), "source_key", "quota", "rank")
    return ranked.unionByName(late).where("rank < quota").select("slot", "source_key", "rank")


def _bucket(key: Column, order: Column, size: Column) -> Column:
    """A part of the shuffle order that sorts like it: the first digits of the order, and for documents without a key,
    whose order is one value, that value and their size. What follows that value among its first digits
    gets a part of its own.
    """
    digits, nothing = F.substring(order, 1, BUCKET_DIGITS), F.md5(F.lit("null").cast("binary"))
    behind = (digits == F.substring(nothing, 1, BUCKET_DIGITS)) & (order > nothing)
    own = F.concat(order, F.lpad(size.cast("string"), 19, "0"))
    return F.when(key.isNull(), own).when(behind, F.concat(digits, F.lit("~"))).otherwise(digits)


def mix(
    df: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    tie: Column | None = None,
    weights: tuple[float, ...] = WEIGHTS,
    epochs: int = MAX_EPOCHS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Adds ``size, source_size, target, taken`` to every row; columns of these names are replaced.

    ``taken`` counts the words of the document that the mix takes, repeats included, at most
    ``epochs`` times its size; the sum over a source is its rounded target. ``size`` defaults
    to the words of ``text``. Null sources form one source, null keys and repeated rows are
    documents like any other (``tie`` orders documents of equal key and size), documents without
    words take part with 0, an empty table stays empty. Names starting with ``mix_`` are reserved.
    """
    size = word_count(F.col("text")) if size is None else size
    name, number = F.col(source).cast("string"), F.coalesce(F.col(key).cast("string"), F.lit("null"))
    rows = df.withColumns({"mix_size": size, "mix_tie": F.lit(0) if tie is None else tie})
    rows = rows.withColumns(
        {"mix_source": F.coalesce(F.concat(F.lit("="), name), F.lit("")), "mix_order": F.md5(number.cast("binary"))}
    ).withColumn("mix_bucket", _bucket(F.col(key), F.col("mix_order"), F.col("mix_size")))

    at = [F.col("mix_source").alias("source_key"), F.col("mix_bucket").alias("bucket")]
    sums = materialize(rows.groupBy(*at).agg(F.sum("mix_size").alias("words"), F.min(name).alias("source")), "mix-sums")
    totals = sums.groupBy("source_key").agg(F.min("source").alias("source"), F.sum("words").alias("source_size"))
    plan = materialize(targets(totals, weights, epochs), "mix-targets")
    running = F.sum("words").over(Window.partitionBy("source_key").orderBy("bucket")) - F.col("words")
    buckets = sums.select("source_key", "bucket", running.alias("mix_before")).join(plan.drop("source"), "source_key")
    buckets = buckets.select(
        F.col("source_key").alias("mix_source"), F.col("bucket").alias("mix_bucket"), "mix_before",
        F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
    )
    inside = Window.partitionBy("mix_source", "mix_bucket").orderBy("mix_order", "mix_size", "mix_tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.join(buckets, ["mix_source", "mix_bucket"])
    placed = placed.withColumn("mix_start", F.col("mix_before") + F.sum("mix_size").over(inside) - F.col("mix_size"))

    end = F.round("mix_target").cast("long")
    runs = placed.where("mix_size > 0").select("mix_source", "mix_start", "mix_size", end.alias("end"), F.explode(
        F.transform(F.sequence(F.lit(0), F.lit(epochs - 1)), lambda e: e * F.col("mix_source_size") + F.col("mix_start"))).alias("first"))
    runs = runs.where("first < end").withColumn("last", F.least(F.col("first") + F.col("mix_size"), F.col("end")))
    block = lambda c: F.floor(c / block_words)
    pieces = runs.withColumn("rank", F.explode(F.sequence(block(F.col("first")), block(F.col("last") - 1))))
    words = F.least("last", (F.col("rank") + 1) * block_words) - F.greatest("first", F.col("rank") * block_words)
    slots = schedule(plan, block_words).select(F.col("source_key").alias("mix_source"), "rank")
    taken = pieces.join(slots, ["mix_source", "rank"]).groupBy("mix_source", "mix_start").agg(F.sum(words).alias("mix_words"))
    out = placed.join(taken, ["mix_source", "mix_start"], "left")
    final = {
        "size": F.col("mix_size"),
        "source_size": F.col("mix_source_size"),
        "target": F.col("mix_target"),
        "taken": F.when(F.col("mix_size") > 0, F.coalesce("mix_words", F.lit(0))).otherwise(0).cast("long"),
    }
    kept = [F.col(c) for c in df.columns if c not in final]
    return out.select(*kept, *(v.alias(k) for k, v in final.items()))
