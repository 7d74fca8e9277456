"""Mixing sources to target weights with a low-discrepancy schedule of equal-token blocks.

DataFrame functions only.
"""

from math import ceil, log2

from pyspark.sql import DataFrame, Window, functions as F

from seriesmart.sources.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # 150 % of all sizes
MOST_REPEATS = 2
BLOCK_TOKENS = 1024
SLOTS_PER_CHUNK = 1024
GOLDEN = 2654435769  # 2**32 over the golden ratio
POINTS = 1 << 32
ROW, AT, TAKEN = "_mixed_row", "_mixed_at", "_mixed_taken"
SPACED_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, seed: int = 0, row: str | None = None) -> DataFrame:
    """``row, doc_id, source, size`` and the digest that shuffles the documents."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select(
        (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(key).alias("digest"),
    )


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source: number, size, weight, target (double) and goal (whole words).

    Sources in order of code points, null last, weigh 5, 2, 1, repeating, and share 150 % of
    all sizes. A target stops at twice its source's size and the excess goes to the others by
    weight. Sorted by cap over weight, a source is capped if its cap is at most what is then
    left for it; all before it are capped too, so two running sums give the level at once.
    """
    order = F.col("source").asc_nulls_last()
    named = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("number", F.row_number().over(Window.orderBy(order)))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("number") - 1) % len(WEIGHTS) + 1))
        .withColumn("cap", F.col("source_size") * MOST_REPEATS)
    )
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    times, over = SHARE
    return (
        named.withColumn("left", times * F.sum("source_size").over(whole) - over * F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(after))
        .withColumn("free", F.col("cap") * over * F.col("weights") > F.col("left") * F.col("weight"))
        .withColumn("level", F.max(F.when(F.col("free"), F.col("left") / (over * F.col("weights")))).over(whole))
        .withColumn("target", F.when(F.col("free"), F.col("weight") * F.col("level")).otherwise(F.col("cap").cast("double")))
        .withColumn("goal", F.floor(F.col("target") + 0.5))
        .select("source", "number", "source_size", "target", "goal")
    )


def schedule(sources: DataFrame, block: int = BLOCK_TOKENS) -> DataFrame:
    """``slot, number, rank``: which source gives a block at each slot, and its how-manieth.

    Slot i has the golden-ratio point ``i * GOLDEN mod 2**32``; the cumulative targets part the
    points among the sources. Points and intervals meet by equal cells of the range, at most
    one interval more per cell than there are sources in it. Ranks come from counts per chunk
    of 1024 slots, so no task ranks a whole source. A source needs ``ceil(goal / block)``
    slots: points beyond that are idle, and the few that are missing follow at the end.
    """
    spark = sources.sparkSession
    n_sources, total = sources.agg(F.count("*"), F.sum("goal")).first()
    slots = ceil((total or 0) / block)
    bits = min(32, ceil(log2(16 * max(1, n_sources))))
    ordered = Window.orderBy("number")
    shared = (
        sources.select("number", "goal", F.sum("goal").over(ordered).alias("high"))
        .withColumn("low", F.col("high") - F.col("goal"))
        .filter("goal > 0")
        .select("number", "goal", *(F.floor(F.col(c) / max(1, total or 0) * POINTS).alias(c) for c in ("low", "high")))
        .withColumn("cell", F.explode(F.expr(f"sequence(shiftright(low, {32 - bits}), shiftright(greatest(high - 1, low), {32 - bits}))")))
    )
    points = spark.range(slots).select(
        F.col("id").alias("slot"), F.expr(f"pmod(pmod(id, {POINTS}) * {GOLDEN}, {POINTS})").alias("point")
    )
    dealt = (
        points.withColumn("cell", F.expr(f"shiftright(point, {32 - bits})"))
        .join(shared, "cell")
        .filter("low <= point AND point < high")
        .select("slot", "number", F.floor(F.col("slot") / SLOTS_PER_CHUNK).alias("chunk"))
    )
    earlier = Window.partitionBy("number").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("number", "chunk").agg(F.count("*").alias("slots"))
    starts = counts.withColumn("start", F.coalesce(F.sum("slots").over(earlier), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("number", "chunk").orderBy("slot")) - 1
    needed = F.ceil(F.col("goal") / block)
    ranked = (
        dealt.withColumn("place", place)
        .join(starts, ["number", "chunk"])
        .select("slot", "number", (F.col("start") + F.col("place")).alias("rank"))
        .join(sources.select("number", needed.alias("needed")), "number")
        .filter("rank < needed")
        .drop("needed")
    )
    had = counts.groupBy("number").agg(F.sum("slots").alias("had"))
    missing = (
        sources.select("number", needed.alias("needed"))
        .join(had, "number", "left")
        .withColumn("had", F.coalesce("had", F.lit(0)))
        .filter("had < needed")
        .select(F.lit(slots).cast("long").alias("slot"), "number", F.explode(F.expr("sequence(had, needed - 1)")).alias("rank"))
    )
    return ranked.unionByName(missing)


def blocks(sizes: DataFrame, sources: DataFrame, block: int = BLOCK_TOKENS) -> DataFrame:
    """``number, rank, row, size, repeat, position, first_word, words``: what each block of a source holds.

    A source's documents stand in the order of their digests, one behind the other, and the
    row of documents is repeated up to MOST_REPEATS times; block r is its words from
    ``r * block`` on, up to the source's goal. Places come from sums per source and digest
    prefix (4096 of them), so no task sums up a whole source.
    """
    tagged = sizes.filter("size > 0").join(sources, sizes["source"].eqNullSafe(sources["source"])).select(
        "row", "size", "digest", "number", "source_size", "goal", F.substring("digest", 1, 3).alias("prefix")
    )
    earlier = Window.partitionBy("number").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        tagged.groupBy("number", "prefix")
        .agg(F.sum("size").alias("words"))
        .select("number", "prefix", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
    )
    running = Window.partitionBy("number", "prefix").orderBy("digest", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        tagged.withColumn("before", F.coalesce(F.sum("size").over(running), F.lit(0)))
        .join(starts, ["number", "prefix"])
        .withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(MOST_REPEATS - 1))))
        .withColumn("first", F.col("start") + F.col("before") + F.col("repeat") * F.col("source_size"))
        .withColumn("end", F.least(F.col("first") + F.col("size"), F.col("goal")))
        .filter("first < end")
    )
    return placed.withColumn("rank", F.explode(F.expr(f"sequence(first div {block}, (end - 1) div {block})"))).select(
        "number",
        "rank",
        "row",
        "size",
        "repeat",
        F.expr(f"greatest(first, rank * {block})").alias("position"),
        F.expr(f"greatest(first, rank * {block}) - first").alias("first_word"),
        F.expr(f"least(end, (rank + 1) * {block}) - greatest(first, rank * {block})").alias("words"),
    )


def mix(
    docs: DataFrame, seed: int = 0, block: int = BLOCK_TOKENS, root: str | None = None, row: str | None = None
) -> DataFrame:
    """``row, doc_id, source, size, source_size, target, taken`` for every document.

    ``taken`` is how many of its words the mix takes, repeats counted: the sum over all slots
    of the schedule of what their blocks hold of the document. A null text has size 0 and
    takes part with nothing; null is a source too; repeated rows are documents of their own,
    tied ids are shuffled by size; an empty table gives no rows. Other columns are not read.
    The order depends on ids, sizes and the seed alone, so reruns agree.
    """
    scratch = Scratch(docs.sparkSession, "mixing", root)
    sizes = scratch.stage(sized(docs, seed, row), "sizes")
    sources = scratch.stage(targets(sizes), "sources")
    taken = (
        schedule(sources, block)
        .join(blocks(sizes, sources, block), ["number", "rank"])
        .groupBy("row")
        .agg(F.sum("words").alias("taken"))
    )
    known = sizes.join(sources, sizes["source"].eqNullSafe(sources["source"])).select(
        "row", "doc_id", sizes["source"], "size", "source_size", "target"
    )
    return known.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def _spans(sizes: DataFrame, sources: DataFrame, block: int) -> DataFrame:
    spans = schedule(sources, block).join(blocks(sizes, sources, block), ["number", "rank"])
    return spans.withColumn("at", F.struct("slot", "number", "rank", "position"))


def scheduled_spans(
    docs: DataFrame, seed: int = 0, block: int = BLOCK_TOKENS, root: str | None = None, row: str | None = None
) -> DataFrame:
    """``slot, source, rank, row, repeat, first_word, words``: the mix itself, in the order of its schedule.

    Each slot has one block of a source, as spans of words of its documents in their shuffled
    order; ``first_word`` counts from 0. The blocks that the points miss share the slot after the last.
    """
    scratch = Scratch(docs.sparkSession, "mixing-spans", root)
    sizes = scratch.stage(sized(docs, seed, row), "sizes")
    sources = scratch.stage(targets(sizes), "sources")
    return (
        _spans(sizes, sources, block)
        .join(F.broadcast(sources.select("number", "source")), "number")
        .orderBy("slot", "number", "rank", "position")
        .select("slot", "source", "rank", "row", "repeat", "first_word", "words")
    )


def mixed_documents(docs: DataFrame, seed: int = 0, block: int = BLOCK_TOKENS, root: str | None = None) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``, in the order of its schedule.

    A document comes as many times as its taken words make of its size, rounded half up;
    what the mix takes less than half of, or what has no words, does not come. A source of
    which nothing would come so gives the taken words of its document instead, other columns
    as they are. Each copy stands where its first words have their slot; ties of the schedule cannot
    be. Repeated rows and tied or null ids are documents of their own, null texts and an empty table give no rows.

    Texts are shuffled to their copies and, once these are written, into the order of the schedule;
    what the first step needed is removed before the second.
    """
    scratch = Scratch(docs.sparkSession, "mixing-documents", root)
    numbered = scratch.stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "documents", codec="zstd")
    sizes = scratch.stage(sized(numbered, seed, ROW), "sizes")
    sources = scratch.stage(targets(sizes), "sources")
    copies = (
        _spans(sizes, sources, block)
        .groupBy("number", "row", "repeat", "size")
        .agg(F.sum("words").alias("words"), F.min("at").alias("at"))
        .withColumn("comes", F.expr("2 * words >= size"))
    )
    copies = scratch.stage(copies, "copies")
    # A source's words are taken in one run, so what would not come is a single part.
    parts = copies.groupBy("number").agg(F.max("comes").alias("any"), F.min(F.struct("at", "row", "words")).alias("part"))
    chosen = copies.filter("comes").select(F.col("row").alias(ROW), F.col("at").alias(AT), F.lit(None).cast("long").alias(TAKEN)).unionByName(
        parts.filter("NOT any").select(F.col("part.row").alias(ROW), F.col("part.at").alias(AT), F.col("part.words").alias(TAKEN))
    )
    pieces = F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col(TAKEN).cast("int")), "")
    found = numbered.join(chosen, ROW).withColumn("text", F.when(F.col(TAKEN).isNull(), F.col("text")).otherwise(cut))
    found = scratch.stage(found.select(*docs.columns, AT), "chosen", codec="zstd")
    for name in ("documents", "sizes", "copies"):
        scratch.remove(name)
    return found.orderBy(AT).select(docs.columns)


SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number
  FROM sizes GROUP BY source
), weighed AS (
  SELECT *, CASE number % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap FROM named
), levels AS (
  SELECT *, 3 * sum(source_size) OVER () - 2 * coalesce(sum(cap) OVER (
           ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         sum(weight) OVER (ORDER BY cap / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM weighed
), marked AS (
  SELECT *, cap * 2 * weights > remaining * weight AS is_free,
         max(CASE WHEN cap * 2 * weights > remaining * weight
             THEN CAST(remaining AS DOUBLE) / CAST(2 * weights AS DOUBLE) END) OVER () AS level
  FROM levels
), goals AS (
  SELECT source, source_size, CASE WHEN is_free THEN weight * level ELSE CAST(cap AS DOUBLE) END AS target
  FROM marked
), placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, CAST(floor(g.target + 0.5) AS BIGINT) AS goal,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.digest, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM sizes s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(0, least(place + size, goal) - place)
          + greatest(0, least(source_size + place + size, goal) - (source_size + place)) AS BIGINT) AS taken
FROM placed
"""
