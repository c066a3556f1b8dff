"""Mixing sources to target weights, in blocks of a fixed number of words.

The words of a source, in document order, are cut into blocks of one length.
The mix is a row of output shards with a fixed number of slots. Each slot
draws a source, which makes the counts of a shard a multinomial draw; what a
source has drawn beyond its total goes to the sources that fell short, so the
totals are met. The running number of a source's slot picks a block: every
pass over the source is a pseudorandom permutation of its block numbers, and
blocks are joined by number.

Everything is a function of ids, seeds and counts, so reruns agree. Only
DataFrame functions are used.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociweave.llm.common import WORD, rest_key, sheltered, stage, text_key

BLOCK_WORDS = 64
SHARD_SLOTS = 1024
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: No source is taken more often than this.
MOST_PASSES = 3
SEED = 10
_CELLS = 1024
_ROUNDS = 16


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, rank, source_size, target`` of rows ``source, size``.

    Sources in code point order, null last, weigh ``WEIGHTS`` in turn and
    share the sum of all sizes; none gets over ``MOST_PASSES`` times its
    size, and what is left over goes to the others by weight. In order of
    the share a source can take for each unit of weight, those who reach
    their limit come first; the level of the others follows from what is
    left. One row for each source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = totals.withColumn("rank", F.row_number().over(order) - 1)
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS)).cast("int"))
    ranked = ranked.withColumns({"weight": weight, "limit": F.col("source_size") * MOST_PASSES})
    up = Window.orderBy((F.col("limit") / F.col("weight")), "rank")
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("weight").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = ranked.withColumn("level", left / weights)
    return levels.select(
        "source", "rank", "source_size",
        F.least(F.col("limit").cast("double"), F.col("weight") * F.max("level").over(every)).alias("target"),
    )


def _plan_sources(targets: DataFrame, block_words: int) -> DataFrame:
    """Adds ``n_blocks``, ``n_slots``, ``last_words`` (of the last slot) and the running sum ``slots_before``."""
    words = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0)).cast("long")
    rest = F.col("words") - F.col("passes") * F.col("source_size")
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    last = F.ceil(F.col("rest") / block_words).cast("long")
    planned = targets.withColumn("words", words).withColumn("passes", passes).withColumn("rest", rest).withColumn("n_blocks", blocks)
    planned = planned.withColumn("n_slots", F.col("passes") * F.col("n_blocks") + last)
    planned = planned.withColumn(
        "last_words", F.when(F.col("rest") > 0, F.col("rest") - (last - 1) * block_words).otherwise(F.lit(block_words))
    )
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return planned.withColumn("slots_before", F.coalesce(F.sum("n_slots").over(before), F.lit(0))).drop("words", "passes", "rest")


def _permuted(index: Column, n: Column, *key: Column) -> Column:
    """Place of ``index`` in a pseudorandom permutation of 0 to ``n - 1``.

    Swap or not: each round pairs numbers by reflection and lets a hash of the
    pair decide whether they change places. It is a permutation for any ``n``.
    """

    def step(x: Column, r: Column) -> Column:
        turn = F.pmod(F.pmod(F.xxhash64(*key, r, F.lit("turn")), n) - x, n)
        swap = F.pmod(F.xxhash64(F.greatest(x, turn), *key, r), F.lit(2)) == 0
        return F.when(swap, turn).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(_ROUNDS - 1)), index, step)


def slot_draws(planned: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """``shard, slot, rank, t``: each slot's source and its running number ``t`` within the source.

    ``planned`` has one row for each source. Slots, and so draws, follow the size of the mix.
    """
    total = int(planned.agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0])
    spark = planned.sparkSession
    width = max(1, -(-total // _CELLS))
    # Source intervals over the drawn numbers, cut at cell borders for an equality join.
    cells = planned.filter("n_slots > 0").select(
        "rank", F.col("slots_before").alias("low"), (F.col("slots_before") + F.col("n_slots")).alias("high"),
        F.explode(F.sequence(F.expr(f"slots_before div {width}"), F.expr(f"(slots_before + n_slots - 1) div {width}"))).alias("cell"),
    )
    drawn = spark.range(total).withColumn("u", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, total))))
    drawn = drawn.withColumn("cell", F.expr(f"u div {width}")).join(cells, "cell").filter("u >= low and u < high")
    drawn = drawn.select(F.expr(f"id div {shard_slots}").alias("shard"), F.col("id").alias("slot"), "rank")
    # Multinomial counts of each shard, and their running sums over the shards: over runs of as many
    # shards as there are runs first, so that no task gets all shards of a source.
    run = max(1, isqrt(-(-total // shard_slots)))
    counts = stage(drawn.groupBy("shard", "rank").agg(F.count("*").alias("n")).withColumn("run", F.expr(f"shard div {run}")), "draws")
    over = Window.partitionBy("rank").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.groupBy("rank", "run").agg(F.sum("n").alias("of_run"))
    runs = runs.select("rank", "run", F.coalesce(F.sum("of_run").over(over), F.lit(0)).alias("before"))
    own = Window.partitionBy("rank", "run").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("inner", F.coalesce(F.sum("n").over(own), F.lit(0))).join(runs, ["rank", "run"])
    base = stage(base.select("shard", "rank", "n", (F.col("before") + F.col("inner")).alias("base")), "counts")
    within = F.row_number().over(Window.partitionBy("shard", "rank").orderBy("slot")) - 1
    numbered = drawn.withColumn("within", within).join(base, ["shard", "rank"]).select(
        "shard", "slot", "rank", (F.col("base") + F.col("within")).alias("t")
    )
    # Sources that drew too many, and those that drew too few, side by side in one numbering.
    got = base.groupBy("rank").agg(F.sum("n").alias("got"))
    state = planned.join(got, "rank", "left").select(
        "rank", "n_slots", F.coalesce("got", F.lit(0)).alias("got"),
        F.greatest(F.coalesce("got", F.lit(0)) - F.col("n_slots"), F.lit(0)).alias("over"),
        F.greatest(F.col("n_slots") - F.coalesce("got", F.lit(0)), F.lit(0)).alias("short"),
    )
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    state = stage(state.withColumns({
        "over_base": F.coalesce(F.sum("over").over(before), F.lit(0)), "short_base": F.coalesce(F.sum("short").over(before), F.lit(0)),
    }), "state")
    missing = state.filter("short > 0").select(
        F.explode(F.sequence(F.col("short_base"), F.col("short_base") + F.col("short") - 1)).alias("place"),
        F.col("rank").alias("new_rank"), (F.col("got") - F.col("short_base")).alias("shift"),
    )
    marked = numbered.join(state.select("rank", "n_slots", "over_base"), "rank").withColumn(
        "place", F.when(F.col("t") >= F.col("n_slots"), F.col("over_base") + F.col("t") - F.col("n_slots"))
    )
    fine = marked.filter("place is null").select("shard", "slot", "rank", "t")
    moved = marked.filter("place is not null").join(missing, "place").select(
        "shard", "slot", F.col("new_rank").alias("rank"), (F.col("place") + F.col("shift")).alias("t")
    )
    return fine.union(moved)


def block_uses(planned: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """``rank, block, pass, words``: the slots' blocks; ``words`` are taken from the block's start."""
    slots = slot_draws(planned, shard_slots, seed).join(planned.select("rank", "n_blocks", "n_slots", "last_words"), "rank")
    turn = F.expr("t div n_blocks")
    block = _permuted(F.col("t") % F.col("n_blocks"), F.col("n_blocks"), F.lit(seed), F.col("rank"), F.col("pass"))
    return slots.withColumn("pass", turn).select(
        "shard", "slot", "rank", "pass", block.alias("block"),
        F.when(F.col("t") == F.col("n_slots") - 1, F.col("last_words")).otherwise(F.lit(block_words)).alias("words"),
    )


def placed_documents(sized: DataFrame) -> DataFrame:
    """Adds ``first``, the number of words of the source before each row, to rows ``rank, doc_id, key, rest, size``.

    Rows stand in order of a hash bucket, id, key, size and rest. Sums are taken in buckets
    first, two for each root of the number of rows, so that neither a
    bucket nor the row of buckets of a source grows with a source.
    """
    n = sized.count()
    buckets = max(1, 2 * isqrt(n))
    dealt = sized.withColumn("bucket", F.pmod(F.xxhash64(F.lit("bucket"), "doc_id", "key"), F.lit(buckets)))
    sums = dealt.groupBy("rank", "bucket").agg(F.sum("size").alias("bucket_size"))
    over = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("rank", "bucket", F.coalesce(F.sum("bucket_size").over(over), F.lit(0)).alias("base"))
    base = stage(base, "base")
    own = Window.partitionBy("rank", "bucket").orderBy("doc_id", "key", "size", "rest").rowsBetween(Window.unboundedPreceding, -1)
    inner = dealt.withColumn("inner", F.coalesce(F.sum("size").over(own), F.lit(0)))
    return inner.join(base, ["rank", "bucket"]).withColumn("first", F.col("base") + F.col("inner")).drop("bucket", "base", "inner")


def mix_plan(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED):
    """``(rows, taken)``: the sized documents, and the stretches of them that the mix takes.

    ``rows``: ``doc_id, key, rest, source, size, source_size, target, rank, first``; ``rest`` is a key of the other columns.
    ``taken``: ``rank, first, pass, start, n`` with ``start`` counted in words
    of the document. A document without words is taken nowhere; rows that
    repeat are taken each. ``docs`` may be empty, and sources null.
    """
    sized = stage(sheltered(docs).select(
        F.col("row.doc_id").alias("doc_id"), text_key(F.col("row.text")).alias("key"), F.col("row.source").alias("source"),
        rest_key(docs).alias("rest"), n_words(F.col("row.text")).alias("size"),
    ), "sized")
    planned = stage(_plan_sources(source_targets(sized), block_words), "planned")
    about = planned.select(F.col("source").alias("its_source"), "rank", "source_size", "target", "n_blocks")
    ranked = sized.join(about, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    rows = stage(placed_documents(ranked), "rows")
    lowest = F.expr(f"first div {block_words}")
    highest = F.expr(f"(first + size - 1) div {block_words}")
    parts = rows.filter("size > 0").select("rank", "first", "size", F.explode(F.sequence(lowest, highest)).alias("block"))
    uses = stage(block_uses(planned, block_words, shard_slots, seed), "slots")
    begin = F.greatest(F.col("block") * block_words, F.col("first"))
    end = F.least(F.col("block") * block_words + F.col("words"), F.col("first") + F.col("size"))
    taken = parts.join(uses, ["rank", "block"]).select(
        "rank", "first", "pass", (begin - F.col("first")).alias("start"), (end - begin).alias("n")
    ).filter("n > 0")
    return rows, taken


def taken_words(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken``."""
    rows, taken = mix_plan(docs, block_words, shard_slots, seed)
    sums = taken.groupBy("rank", "first").agg(F.sum("n").alias("taken"))
    # A document without words shares its ``first`` with the next one.
    some = rows.join(sums, ["rank", "first"], "left")
    words = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("long")
    return some.select("doc_id", "source", "size", "source_size", "target", words.alias("taken"))


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The mix as documents: a row for each document and pass that takes words of it, with those words.

    Words keep the white space that follows them; ``n_chars``, where there is
    such a column, follows the text. A document taken in several passes has
    several rows; one that is not taken has none. Rows that repeat id, text and
    source keep their own other columns.
    """
    rows, taken = mix_plan(docs, block_words, shard_slots, seed)
    spans = taken.groupBy("rank", "first", "pass").agg(F.array_sort(F.collect_list(F.struct("start", "n"))).alias("spans"))
    plan = spans.join(rows.filter("size > 0"), ["rank", "first"]).select(
        F.col("doc_id").alias("its_id"), F.col("key").alias("its_key"), F.col("rest").alias("its_rest"), "spans", "size"
    )
    texts = sheltered(docs).filter(F.col("row.text").rlike(WORD))
    texts = texts.withColumns({"id": F.col("row.doc_id"), "key": text_key(F.col("row.text")), "rest": rest_key(docs)})
    # Rows of the plan are one for each repeat; of rows equal in every column the text is needed once.
    once = texts.dropDuplicates(["id", "key", "rest"])
    both = once.join(
        plan, F.col("id").eqNullSafe(F.col("its_id")) & (F.col("key") == F.col("its_key")) & (F.col("rest") == F.col("its_rest"))
    )
    tokens = both.withColumn("tokens", F.regexp_extract_all("row.text", F.lit(WORD + r"[\x20\x09-\x0D]*"), 0))
    text = F.array_join(
        F.transform("spans", lambda s: F.array_join(F.slice("tokens", (s["start"] + 1).cast("int"), s["n"].cast("int")), "")), ""
    )
    whole = (F.size("spans") > 0) & (F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["n"]) == F.col("size"))
    out = tokens.withColumn("mixed", F.when(whole, F.col("row.text")).otherwise(text))
    return out.select(*[
        F.col("mixed").alias(c) if c == "text"
        else F.length("mixed").cast("long").alias(c) if c == "n_chars"
        else F.col("row")[c].alias(c)
        for c in docs.columns
    ])
