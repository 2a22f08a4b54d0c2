"""Mixing sources to target weights along a low-discrepancy schedule, with DataFrame operations only.

1. Every source gets a target: its weight's share of all words, at most ``most`` times what it has; the excess goes to the
   others by weight (``targets``).
2. Each source's documents are shuffled by a keyed hash and laid end to end; the line is cut into blocks of equal words.
3. Slot i of the schedule belongs to the source under the i-th golden-ratio point, read through the cumulative
   targets. Ranked within its source, the k-th slot takes the k-th block, round and round until the target is met.
4. A document is taken as often as the slots take the blocks it lies in.

Ranks and positions are sums over cells of bounded size plus sums inside a cell, so a source with a third of all
rows is many groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.scratch import new_dir

BLOCK_WORDS = 64
#: Documents in a cell of a source's line, and slots in a cell of the schedule, about.
CELL_ROWS = 10_000
#: Steps of the grid that finds a point's source by an equi-join.
GRID = 4096
#: 2**32 over the golden ratio, odd.
GOLDEN = 2654435769

WORD = r"[^\x20\x09-\x0D]+"


def _saved(df: DataFrame, label: str) -> DataFrame:
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, most: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """One row per source: ``src, source_size, target``, from rows ``src, size``.

    Sources in code-point order (null last) weigh ``weights``, repeating. Targets stop at ``most`` times the source's words.
    """
    by_source = sized.groupBy("src").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("src").isNull(), "src")
    place = (F.row_number().over(ordered) - 1) % len(weights) + 1
    weighed = by_source.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), place.cast("int"))).withColumn(
        "cap", F.col("source_size") * most
    )
    # in order of the level at which they are full, the first source that stays below its cap sets the level
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("src").isNull(), "src")
    below = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("cap").over(below), F.lit(0))).cast("double") / F.sum("w").over(rest).cast("double")
    levelled = weighed.withColumn("own", level)
    level = F.min(F.when(F.col("own") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), F.col("own").alias("level")))).over(everything)["level"]
    return levelled.withColumn("level", level).select(
        "src", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")).alias("target")
    )


def lined_up(sized: DataFrame, seed: int) -> DataFrame:
    """``sized`` (``row, doc_id, src, size, tie``) with ``start``: the words before the row on its source's shuffled line."""
    cells = max(1, sized.count() // CELL_ROWS)
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    cell = F.floor(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * cells / F.lit(1 << 32)).cast("long")
    keyed = sized.withColumn("digest", digest).withColumn("cell", cell)
    sums = keyed.groupBy("src", "cell").agg(F.sum("size").alias("words"))
    along = Window.partitionBy("src").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("src", "cell", F.coalesce(F.sum("words").over(along), F.lit(0)).alias("base"))
    within = Window.partitionBy("src", "cell").orderBy("digest", "doc_id", "size", "tie")
    placed = keyed.select(
        "row", "src", "size", "cell", (F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("at")
    )
    same = placed["src"].eqNullSafe(before["src"]) & (placed["cell"] == before["cell"])
    return placed.join(before, same).select("row", placed["src"], "size", (F.col("base") + F.col("at")).alias("start"))


def schedule(goals: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """``slot, src, rank, block, words``: which block each slot takes, and how many of its words.

    ``goals`` has ``src, source_size, target``. The words of a source's slots add up to its target, rounded down.
    """
    spark = goals.sparkSession
    goal = goals.withColumn("quota", F.floor("target").cast("long")).filter("quota > 0")
    goal = goal.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long")).withColumn(
        "needed",
        F.expr(f"(quota div source_size) * blocks + ceil(mod(quota, source_size) / {block})").cast("long"),
    )
    total = Window.partitionBy()
    up_to = Window.orderBy(F.col("src").isNull(), "src").rowsBetween(Window.unboundedPreceding, 0)
    share = goal.withColumn("high", F.sum("needed").over(up_to)).withColumn("all", F.sum("needed").over(total))
    share = _saved(share.withColumn("low", F.col("high") - F.col("needed")), "mix-goals")
    slots = share.agg(F.max("all")).first()[0] or 0
    # the source under a point: an equi-join on the grid, then the exact bounds
    grid = share.withColumn("edge", F.explode(F.sequence(F.floor(F.col("low") * GRID / F.col("all")), F.floor((F.col("high") - 1) * GRID / F.col("all"))))).select("edge", "src", "low", "high")
    point = (F.pmod(F.col("id") + 1, F.lit(1 << 31)) * F.lit(GOLDEN)) % F.lit(1 << 32)
    points = spark.range(slots).select(
        F.col("id").alias("slot"), F.floor(point.cast("double") * slots / float(1 << 32)).cast("long").alias("under")
    )
    drawn = (
        points.withColumn("edge", F.floor(F.col("under") * GRID / F.lit(max(1, slots))))
        .join(grid, "edge")
        .filter("under >= low AND under < high")
        .select("slot", "src", F.expr(f"slot div {CELL_ROWS}").alias("cell"))
    )
    counts = drawn.groupBy("src", "cell").agg(F.count("*").alias("n"))
    along = Window.partitionBy("src").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = _saved(counts.withColumn("base", F.coalesce(F.sum("n").over(along), F.lit(0))), "mix-ranks")
    within = Window.partitionBy("src", "cell").orderBy("slot")
    ranked = drawn.withColumn("at", F.row_number().over(within) - 1)
    same = ranked["src"].eqNullSafe(counts["src"]) & (ranked["cell"] == counts["cell"])
    ranked = ranked.join(counts, same).select("slot", ranked["src"], (F.col("base") + F.col("at")).alias("rank"))
    # a source that the points passed over a few times too often gets its last slots at the end
    drawn_of = counts.groupBy("src").agg(F.sum("n").alias("n"))
    late = share.join(drawn_of, share["src"].eqNullSafe(drawn_of["src"]), "left").filter("needed > coalesce(n, 0)").select(
        F.lit(slots).alias("slot"), share["src"], F.explode(F.expr("sequence(coalesce(n, 0), needed - 1)")).alias("rank")
    )
    every = ranked.unionByName(late)
    facts = share.select("src", "source_size", "quota", "blocks")
    joined = every.join(facts, every["src"].eqNullSafe(facts["src"])).select("slot", every["src"], "rank", "source_size", "quota", "blocks")
    first = F.expr(f"(rank div blocks) * source_size + mod(rank, blocks) * {block}")
    return (
        joined.withColumn("block", F.expr("mod(rank, blocks)"))
        .withColumn("words", F.least(F.lit(block), F.col("source_size") - F.col("block") * block, F.col("quota") - first))
        .filter("words > 0")
        .select("slot", "src", "rank", "block", "words")
    )


def mix(
    docs: DataFrame,
    seed: int = 17,
    block: int = BLOCK_WORDS,
    most: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken`` (words of it in the mix, repetitions counted).

    A null or empty text has no words and is taken 0 times; null sources are one source, the last. Rows that
    share an id count one by one; a null id is an id like others. A source of no words has a target of 0. An empty table gives no rows.
    """
    sized = _saved(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("src"),
            word_count(F.col(text_col)).alias("size"),
            F.xxhash64(F.col(text_col)).alias("tie"),
        ),
        "mix-sizes",
    )
    goals = _saved(targets(sized, most), "mix-targets")
    plan = schedule(goals, block)
    times = plan.groupBy("src", "block").agg(
        F.count("*").alias("n"),
        F.sum("words").alias("words"),
        F.min("words").alias("least"),
        F.max("words").alias("whole"),
    )
    line = lined_up(sized.filter("size > 0"), seed)
    parts = line.select(
        "row", "src", "start", "size",
        F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("block"),
    )
    same = parts["src"].eqNullSafe(times["src"]) & (parts["block"] == times["block"])
    low = F.greatest(F.col("start") - parts["block"] * block, F.lit(0))
    high = lambda words: F.greatest(F.least(F.col("start") + F.col("size") - parts["block"] * block, words), low)
    # all slots of a block take it whole, but perhaps the last, which takes its first words
    taken = (high(F.col("whole")) - low) * (F.col("n") - 1) + (high(F.col("least")) - low)
    per_row = parts.join(times, same).select("row", taken.alias("taken")).groupBy("row").agg(F.sum("taken").alias("taken"))
    out = sized.join(per_row, "row", "left")
    return out.join(goals, out["src"].eqNullSafe(goals["src"])).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
