"""Mixing sources to target weights by a low-discrepancy schedule.

Slot k of the schedule draws the golden-ratio point frac(k * phi), which the
cumulative target shares map to a source; the slots of a source are ranked, and
rank r takes the source's r-th block of ``block_words`` words. A source's
documents lie shuffled (by hash of id) one after the other, epoch after epoch,
so that every block has equally many words. Ranks and word offsets are prefix
sums taken over buckets first, so a source with a third of all rows is spread
over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import stored, unused, word_count

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
BLOCK_WORDS = 256
SLOTS_A_BUCKET = 1 << 16
ROWS_A_BUCKET = 2_000
SEED = 17
# Golden-ratio points as integers: x_k = (k * PHI mod 2^31) / 2^31, PHI = 2^31 / phi.
PHI, POINTS = 1327217885, 1 << 31
# Bands of the unit interval are looked up by cell, an equi-join.
CELLS = 1024


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``source, source_size, n_rows`` to the same with ``sid, weight, target``: one row per source.

    Sources by code point, null last, get the weights in turn. Shares of all
    words in proportion to the weights, no target above ``most_epochs`` times
    its source's size, the excess reshared: that is target = min(cap, level *
    weight) for the one level at which targets add up to all words. Sources
    are ordered by cap / weight; the level is the smallest one at which the
    sources below it are full. Every window here is over one row per source.
    """
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy(F.col("source").asc_nulls_last())
    k = F.row_number().over(by_name) - 1
    rows = sizes.withColumn("sid", k.cast("int"))
    rows = rows.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("sid") % len(weights)))
    rows = rows.withColumn("cap", F.col("source_size") * float(most_epochs)).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = every.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(every)
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # with the sources before this one full, the others share what is left
    rows = rows.withColumn("level_here", left / open_weight)
    first = F.min(F.when(F.col("level_here") <= F.col("ratio"), F.struct("ratio", "sid", "level_here"))).over(every)
    target = F.least("cap", F.coalesce(first["level_here"], F.max("ratio").over(every)) * F.col("weight"))
    return rows.select("source", "source_size", "n_rows", "sid", "weight", target.alias("target"))


def running(df: DataFrame, group: str, bucket: str, order: list[Column], amount: Column, out: str) -> DataFrame:
    """Sum of ``amount`` over the rows before this one within ``group``, in order of ``bucket`` and then ``order``.

    Sums per bucket are added up first; the row-level window sees one bucket only.
    """
    amounts = df.withColumn("_amount", amount)
    per = amounts.groupBy(group, bucket).agg(F.sum("_amount").alias("_sum"))
    ahead = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(group, bucket, F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = amounts.withColumn("_before", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
    return local.join(per, [group, bucket]).withColumn(out, F.col("_before") + F.col("_base")).drop("_amount", "_before", "_base")


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``slot, sid, rank``: which source each slot draws, and which of its blocks.

    There is a slot for every ``block_words`` of all targets, so the table grows
    with the corpus; it is made and ranked in parallel.
    """
    spark = targets.sparkSession
    n_slots = int(targets.agg(F.ceil(F.sum("target") / block_words)).first()[0] or 0)
    every = Window.partitionBy(F.lit(0))
    so_far = every.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    whole = F.sum("target").over(every)
    bands = targets.filter("target > 0").select(
        "sid",
        ((F.sum("target").over(so_far) - F.col("target")) / whole).alias("low"),
        F.when(F.lead("sid").over(every.orderBy("sid")).isNull(), F.lit(1.0)).otherwise(F.sum("target").over(so_far) / whole).alias("high"),
    )
    cells = F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1).cast("long")))
    bands = bands.withColumn("cell", F.explode(cells))
    points = spark.range(n_slots).select(F.col("id").alias("slot"), (F.pmod(F.col("id") % POINTS * PHI, F.lit(POINTS)) / POINTS).alias("x"))
    points = points.withColumn("cell", F.floor(F.col("x") * CELLS))
    drawn = points.join(bands, (points["cell"] == bands["cell"]) & (F.col("x") >= F.col("low")) & (F.col("x") < F.col("high"))).select("slot", "sid")
    bucketed = drawn.withColumn("bucket", F.floor(F.col("slot") / SLOTS_A_BUCKET))
    return running(bucketed, "sid", "bucket", [F.col("slot")], F.lit(1).cast("long"), "rank").select("slot", "sid", "rank")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``: one row per (id, source).

    size counts words (null text: 0), taken the words the mix takes of the
    document, repeats counted, never more than ``most_epochs`` times its size.
    Repeated rows with one id and source are one document of their summed size;
    a null id is an id like any other, a null source a source that sorts last.
    The shuffle is by a hash of the id, so reruns agree. A document without
    words is taken 0 times. An empty table gives no rows; further columns are
    ignored.
    """
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    sized = stored(sized.groupBy("doc_id", "source").agg(F.sum("size").alias("size")), "sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    targets = stored(source_targets(sizes, weights, most_epochs), "targets")
    slots = stored(schedule(targets, block_words), "schedule")
    drawn = slots.groupBy("sid").agg(F.count("*").alias("n_slots"))
    per_source = targets.join(drawn, "sid", "left").withColumnRenamed("source", "target_source")

    rows = sized.join(per_source, F.col("source").eqNullSafe(F.col("target_source"))).drop("target_source")
    key = F.xxhash64(F.lit(SEED), "doc_id")
    rows = rows.withColumn("key", key).withColumn("bucket", F.pmod("key", F.ceil(F.col("n_rows") / ROWS_A_BUCKET)))
    placed = running(rows, "sid", "bucket", [F.col("key"), F.col("doc_id")], F.col("size"), "offset")

    start = F.col("epoch") * F.col("source_size") + F.col("offset")
    passes = placed.filter("size > 0 and n_slots > 0").withColumn("epoch", F.explode(F.array(*[F.lit(e).cast("long") for e in range(most_epochs)])))
    passes = passes.select("doc_id", "sid", "size", "n_slots", start.alias("start")).filter(F.col("start") < F.col("n_slots") * block_words)
    first, final = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    pieces = passes.withColumn("block", F.explode(F.sequence(first, F.least(final, F.col("n_slots") - 1))))
    words = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - F.greatest(F.col("start"), F.col("block") * block_words)
    pieces = pieces.select("doc_id", "sid", "block", words.alias("words"))
    taken = pieces.join(slots, (pieces["sid"] == slots["sid"]) & (F.col("block") == F.col("rank"))).groupBy("doc_id", pieces["sid"].alias("taken_sid")).agg(F.sum("words").alias("taken"))
    taken = taken.withColumnRenamed("doc_id", "taken_id")
    out = rows.join(taken, F.col("doc_id").eqNullSafe(F.col("taken_id")) & (F.col("sid") == F.col("taken_sid")), "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (to the nearest whole number of times).

    At the end of a source's share one document is taken in part; it comes in
    whole when at least half of it is taken. Columns stay as they are.
    """
    takes = mix(docs, id_col, text_col, source_col, **how)
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    own_id, own_source, n, copy = (unused(docs, f"_mix_{x}") for x in ("id", "source", "times", "copy"))
    takes = takes.select(F.col("doc_id").alias(own_id), F.col("source").alias(own_source), times.alias(n)).filter(F.col(n) > 0)
    joined = docs.join(takes, docs[id_col].eqNullSafe(takes[own_id]) & docs[source_col].eqNullSafe(takes[own_source]))
    return joined.select(*[docs[c] for c in docs.columns], F.explode(F.array_repeat(F.lit(0), F.col(n))).alias(copy)).drop(copy)
