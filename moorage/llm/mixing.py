"""Mixtures of sources to target weights, by blocks and a multivariate-hypergeometric splitting tree.

DataFrame and SQL functions only. Every document falls by hash into one of the blocks of its source. A source that is
larger than its target has the more blocks, so that the target is always some ``SHARE`` of them or more.
What is large (documents) is only ever counted by block and joined with the chosen blocks; what is ordered or ranked
are tables of drawn blocks, candidates and sources, whose size ``BLOCKS`` and ``POOL`` bound whatever the number of documents.

* Targets: sources share all words by weight; none gets more than ``repeats`` times its own, the excess is reshared.
* Block quotas: whole passes over a source as often as its target allows, then blocks in permuted order as long as
  they fit twice into what is left (in every second trial: once), then the largest that fit, and one more where that comes nearer to the target.
  A source of few blocks tries several permutations. Of more than ``BLOCKS`` blocks that could be taken, so many drawn
  by hash are the candidates; where they hold too few words, all other blocks follow in permuted order by a running sum.
* Splitting tree: the pool of chosen blocks of all sources is halved again and again, each half a draw without
  replacement, so the counts by source follow the multivariate hypergeometric distribution and sum to the quotas.
* Each output shard draws its quota from the permuted blocks of each source, no two shards the same, and orders its
  documents by a hash of its own.

Nulls: a null source is a source of its own, the last; a null text has size 0; a row without id is treated like any
other. Rows that are repeated are taken together or not at all. An empty table gives an empty mixture.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, Window, functions as F

from moorage.llm.common import join_stored
from moorage.session import materialise

BLOCKS = 4096  # blocks of a source, at most
POOL = 1 << 20  # blocks of all sources, about; a source has 16 at least
SHARE = 64  # blocks that make up the target of a source larger than it; 16 at least where sources are very many
WORDS_PER_SHARD = 4_000_000
MOST_SPLITS = 14  # levels of the splitting tree
SMALL_SOURCE, TRIALS = 512, 32  # sources of so few blocks try so many permutations, and keep the nearest to the target


def words(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _bin(source: str) -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit(""))


def _place(id_column: str, source: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_column), F.col(source))


def sized(docs: DataFrame, id_column: str, source: str, text: str, seed: int) -> DataFrame:
    """Id, source, size and place of each document: the one pass over the texts, stored."""
    return materialise(
        docs.select(
            F.col(id_column).alias("id"),
            F.col(source).alias("source"),
            _bin(source).alias("bin"),
            words(F.col(text)).alias("size"),
            _place(id_column, source, seed).alias("place"),
        ),
        "mix-sizes",
    )


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), repeats: int = 3) -> DataFrame:
    """One row per source: source_size and target. The windows hold one row per source.

    With sources in ascending order of what they can take per weight, those before some point take all they can,
    and those from there on share the rest by weight: the same targets as resharing round after round.
    """
    sums = sizes.groupBy("bin").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    full = F.col("source_size") * F.lit(float(repeats))
    order = Window.orderBy("fill", "bin")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sums.withColumn("weight", weight).withColumn("full", full).withColumn("fill", F.col("full") / F.col("weight"))
    levels = ranked.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
        / F.sum("weight").over(after),
    )
    chosen = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "bin", "level"))).over(everything)
    level = F.coalesce(chosen["level"], F.max("level").over(everything))
    target = F.when(F.col("source_size") == 0, 0.0).otherwise(F.least("full", level * F.col("weight")))
    return levels.select("bin", "source", "source_size", target.alias("target"))


def block_count(sources: int) -> int:
    """Blocks of each source whose target does not ask for more."""
    return max(16, min(BLOCKS, POOL // max(1, sources)))


def finer_sources(goals: DataFrame, sources: int) -> DataFrame:
    """Sources that need more blocks than ``block_count``, as their target is a small part of them: bin, blocks. Stored."""
    share = max(16, min(SHARE, POOL // max(1, sources)))
    need = F.ceil(F.col("source_size") / F.col("target") * share).cast("bigint")
    small = goals.where("target > 0 AND target < source_size").select("bin", need.alias("blocks"))
    return materialise(small.where(F.col("blocks") > block_count(sources)), "mix-finer")


def with_block(rows: DataFrame, finer: DataFrame, blocks: int) -> DataFrame:
    """Rows that have bin and place, with the block they fall into."""
    counted = join_stored(rows, finer, ["bin"], "left", 80)
    block = F.pmod("place", F.coalesce("blocks", F.lit(blocks).cast("bigint")))
    return counted.withColumn("block", block).drop("place", "blocks")


def draws(sizes: DataFrame, goals: DataFrame, finer: DataFrame, blocks: int, seed: int) -> DataFrame:
    """The chosen blocks: bin, block, pass. ``goals`` is what ``targets`` gives, stored."""
    placed = with_block(sizes.select("bin", "place", "size"), finer, blocks)
    held = materialise(placed.groupBy("bin", "block").agg(F.sum("size").alias("words")).where("words > 0"), "mix-blocks")
    passes = F.floor(F.col("target") / F.col("source_size")).cast("int")
    plan = goals.where("source_size > 0").withColumn("passes", passes)
    plan = plan.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    whole = held.join(plan, "bin").select("bin", "block", F.explode(F.when(F.col("passes") > 0, F.sequence(F.lit(1), "passes"))).alias("pass"))
    # A block of twice the rest or more is never taken. The window drops rows before its shuffle.
    fitting = held.join(plan.select("bin", "rest"), "bin").where(F.col("words") < 2 * F.col("rest"))
    at = Window.partitionBy("bin").orderBy(F.xxhash64(F.lit(seed + 5), "bin", "block"), "block")
    ranked = fitting.withColumn("at", F.row_number().over(at))
    candidates = ranked.where(F.col("at") <= BLOCKS)
    queue = F.collect_list(F.struct("block", "words"))
    queues = candidates.groupBy("bin").agg(queue.alias("queue")).join(plan, "bin")
    trials = F.when(F.size("queue") <= SMALL_SOURCE, TRIALS).otherwise(1)
    tried = queues.withColumn("trial", F.explode(F.sequence(F.lit(1), trials)))
    lot = F.transform(
        "queue",
        lambda item: F.struct(
            F.xxhash64(F.lit(seed + 1), "trial", "bin", item["block"]).alias("at"),
            item["block"].alias("block"),
            item["words"].alias("words"),
        ),
    )
    last = tried.withColumn("queue", F.array_sort(lot))
    nothing = F.struct(F.col("rest").cast("double").alias("rest"), F.array().cast("array<bigint>").alias("blocks"))

    def filled_up(queue: Column, state: Column, room: Column) -> Column:
        """Takes each block in turn that fits ``room`` times into what is left."""
        return F.aggregate(
            queue,
            state,
            lambda state, item: F.when(
                item["words"] * room <= state["rest"],
                F.struct(
                    (state["rest"] - item["words"]).alias("rest"),
                    F.array_append(state["blocks"], item["block"]).alias("blocks"),
                ),
            ).otherwise(state),
        )

    last = last.withColumn("drawn", filled_up(F.col("queue"), nothing, F.col("trial") % 2 + 1))
    untaken = F.filter("queue", lambda item: ~F.array_contains(F.col("drawn.blocks"), item["block"]))
    by_size = F.transform(untaken, lambda item: F.struct((-item["words"]).alias("least"), item["at"].alias("at"), item["words"].alias("words"), item["block"].alias("block")))
    taken = filled_up(F.array_sort(by_size), F.col("drawn"), F.lit(1))
    filled = last.withColumn("taken", taken)
    gap, blocks_taken = F.col("taken.rest"), F.col("taken.blocks")
    over = F.transform(
        F.filter("queue", lambda item: ~F.array_contains(blocks_taken, item["block"])),
        lambda item: F.struct(F.abs(item["words"] - gap).alias("error"), item["at"].alias("at"), item["block"].alias("block")),
    )
    one_more = F.filter(F.array(F.array_min(over)), lambda item: item["error"] < gap)
    chosen = F.concat(blocks_taken, F.transform(one_more, lambda item: item["block"]))
    error = F.coalesce(F.get(one_more, F.lit(0))["error"], gap)
    best = filled.withColumn("chosen", chosen).groupBy("bin", "passes").agg(F.min_by("chosen", F.struct(error, "trial")).alias("chosen"))
    part = materialise(best.select("bin", F.explode("chosen").alias("block"), (F.col("passes") + 1).alias("pass")), "mix-part")
    many = materialise(fitting.groupBy("bin").count().where(F.col("count") > BLOCKS).select("bin"), "mix-many")
    if not many.isEmpty():
        part = part.unionByName(topped_up(fitting.join(many, "bin", "left_semi"), part, plan, seed))
    return whole.unionByName(part)


def topped_up(fitting: DataFrame, part: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Further blocks of sources whose candidates fell short of the target: bin, block, pass.

    Blocks that aren't taken come in permuted order as long as their running sum stays within what is missing. Blocks
    too large for that are left out first, so they stop nobody.
    """
    taken = fitting.join(part.select("bin", "block"), ["bin", "block"]).groupBy("bin").agg(F.sum("words").alias("got"))
    short = plan.join(taken, "bin", "left").withColumn("missing", F.col("rest") - F.coalesce("got", F.lit(0)))
    short = short.where(F.col("missing") > 0).select("bin", "passes", "missing")
    free = fitting.drop("rest").join(part.select("bin", "block"), ["bin", "block"], "left_anti").join(short, "bin")
    order = Window.partitionBy("bin").orderBy(F.xxhash64(F.lit(seed + 6), "bin", "block"), "block")
    summed = free.where(F.col("words") <= F.col("missing")).withColumn("so_far", F.sum("words").over(order))
    return summed.where(F.col("so_far") <= F.col("missing")).select("bin", "block", (F.col("passes") + 1).alias("pass"))


def split(drawn: DataFrame, depth: int, seed: int) -> DataFrame:
    """Output shard of each drawn block: bin, block, pass, shard, of 2 ** depth shards."""
    pool = drawn.withColumn("node", F.lit(0))
    for level in range(depth):
        node = Window.partitionBy("node")
        lot = F.xxhash64(F.lit(seed + 2), F.lit(level), "bin", "block", "pass")
        right = F.row_number().over(node.orderBy(lot, "bin", "block", "pass")) > F.ceil(F.count("*").over(node) / 2)
        pool = pool.withColumn("node", F.col("node") * 2 + right.cast("int"))
    quota = F.row_number().over(Window.partitionBy("bin").orderBy("node"))
    order = F.xxhash64(F.lit(seed + 3), "bin", "block", "pass")
    place = F.row_number().over(Window.partitionBy("bin").orderBy(order, "block", "pass"))
    quotas = pool.select("bin", F.col("node").alias("shard"), quota.alias("place"))
    return drawn.withColumn("place", place).join(quotas, ["bin", "place"]).drop("place")


def plan_mixture(
    docs: DataFrame,
    id_column: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = (1, 2, 3),
    repeats: int = 3,
    seed: int = 0,
    words_per_shard: int = WORDS_PER_SHARD,
) -> tuple[DataFrame, DataFrame, DataFrame, Callable[[DataFrame], DataFrame], int]:
    """Sizes, targets and drawn blocks with their shards, all stored; what gives rows their block; number of shards."""
    sizes = sized(docs, id_column, source, text, seed)
    goals = materialise(targets(sizes, weights, repeats), "mix-targets")
    sources, total = goals.agg(F.count("*"), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    blocks, finer = block_count(sources), finer_sources(goals, sources)
    depth = min(MOST_SPLITS, (total // words_per_shard).bit_length())
    drawn = materialise(draws(sizes, goals, finer, blocks, seed), "mix-drawn")  # split reads it twice
    shards = materialise(split(drawn, depth, seed), "mix-shards")
    return sizes, goals, shards, partial(with_block, finer=finer, blocks=blocks), 2**depth


def mixture_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken. See ``plan_mixture`` for the options."""
    sizes, goals, shards, placed, _ = plan_mixture(docs, **options)
    copies = materialise(shards.groupBy("bin", "block").agg(F.count("*").alias("copies")), "mix-copies")
    counted = join_stored(placed(sizes), copies, ["bin", "block"], "left", 80)
    return join_stored(counted, goals.drop("source"), ["bin"], "inner", 120).select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.coalesce("copies", F.lit(0))).cast("bigint").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: rows of ``docs``, each as often as it is taken, dealt to the shards and shuffled in each."""
    _, _, shards, placed, count = plan_mixture(docs, **options)
    id_column, source, seed = options.get("id_column", "doc_id"), options.get("source", "source"), options.get("seed", 0)
    dealt = materialise(shards.groupBy("bin", "block").agg(F.sort_array(F.collect_list("shard")).alias("shards")), "mix-dealt")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        _bin(source).alias("bin"),
        _place(id_column, source, seed).alias("place"),
    )
    rows = join_stored(placed(keyed), dealt, ["bin", "block"], "inner", 120).select("row", F.posexplode("shards").alias("copy", "shard"))
    shuffled = rows.repartitionById(count, F.col("shard")).sortWithinPartitions(
        "shard", F.xxhash64(F.lit(seed + 4), "shard", f"row.{id_column}", "copy")
    )
    return shuffled.select("row.*")
