"""Product pairs bought together."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.session import materialised, setting

BLOCK_ITEMS = 1_000
#: Rows or pairs a task groups at a time, about: what a task holds does not grow with the table.
TASK_ROWS = 500_000
#: As bytes of files, and of shuffled rows that may be put together in a task.
TASK_BYTES = 16 << 20
_SEED_ITEMS = 64


@contextmanager
def _tasks_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """So small tasks, for the jobs inside the block, that each groups about ``TASK_ROWS`` rows."""
    now = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    small = {"spark.sql.shuffle.partitions": max(now, -(-rows // TASK_ROWS)), "spark.sql.files.maxPartitionBytes": TASK_BYTES,
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES}
    with ExitStack() as stack:
        for key, value in small.items():
            stack.enter_context(setting(spark, key, str(value)))
        yield


@dataclass(frozen=True)
class BasketSizes:
    """Items of the largest basket, and pairs of different items in all baskets."""

    largest: int
    pairs: int


def basket_sizes(totals: DataFrame) -> BasketSizes:
    """Counts only, one row to the driver."""
    n = F.col("n")
    row = totals.groupBy("basket").agg(F.count(F.lit(1)).alias("n")).agg(
        F.max(n), F.sum((n * (n - 1)).cast("decimal(38,0)"))).first()
    return BasketSizes(row[0] or 0, int(row[1] or 0) // 2)


def item_totals(lines: DataFrame, basket: str, item: str, quantity: str) -> DataFrame:
    """One row per (basket, item): summed quantity and summed squares.

    All pairs of an item's own lines, and all products between two items, follow
    from these two sums, so line pairs are never formed.
    """
    return lines.groupBy(F.col(basket).alias("basket"), F.col(item).alias("item")).agg(
        F.sum(quantity).alias("q"), F.sum(F.col(quantity) * F.col(quantity)).alias("q2"), F.count(F.lit(1)).alias("k")
    )


def _same_item(totals: DataFrame) -> DataFrame:
    own = totals.filter(F.col("k") > 1).groupBy("item").agg(F.sum((F.col("q") * F.col("q") - F.col("q2")) / 2).alias("weight"))
    return own.select(F.col("item").alias("item_a"), F.col("item").alias("item_b"), "weight")


def _cross_items(totals: DataFrame, block_items: int, sizes: BasketSizes | None = None) -> DataFrame:
    """Weights of pairs of different items.

    If a basket has more than ``block_items`` items, baskets are cut into blocks
    of that size and each pair (block i, block j) is a join key of its own, so
    no task meets more than ``block_items`` squared pairs of one basket at once.
    """
    rows = totals.select("basket", "item", "q")
    if (sizes or basket_sizes(rows)).largest <= block_items:
        a, b = rows.alias("a"), rows.alias("b")
        pairs = a.join(b, (F.col("a.basket") == F.col("b.basket")) & (F.col("a.item") < F.col("b.item")))
        pairs = pairs.select(F.col("a.item").alias("item_a"), F.col("b.item").alias("item_b"), (F.col("a.q") * F.col("b.q")).alias("w"))
    else:
        sizes = rows.groupBy("basket").agg(F.count(F.lit(1)).alias("__items")).filter(F.col("__items") > 1)
        rows = rows.join(sizes, "basket").withColumn("__blocks", F.ceil(F.col("__items") / block_items).cast("int"))
        rows = rows.withColumn("__block", F.pmod(F.xxhash64("item"), F.col("__blocks")).cast("int"))
        others = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
        a = rows.select("basket", F.col("item").alias("item_a"), F.col("q").alias("q_a"), F.col("__block").alias("i"), others.alias("j"))
        b = rows.select("basket", F.col("item").alias("item_b"), F.col("q").alias("q_b"), F.col("__block").alias("j"), others.alias("i"))
        pairs = a.join(b, ["basket", "i", "j"]).filter(F.col("item_a") < F.col("item_b"))
        pairs = pairs.select("item_a", "item_b", (F.col("q_a") * F.col("q_b")).alias("w"))
    return pairs.groupBy("item_a", "item_b").agg(F.sum("w").alias("weight"))


def pair_weights(totals: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Weight of every item pair, including two lines of the same item."""
    return _cross_items(totals, block_items).unionByName(_same_item(totals))


def pair_cooccurrence(
    lines: DataFrame, basket: str, item: str, quantity: str, n: int, block_items: int = BLOCK_ITEMS
) -> DataFrame:
    """The n heaviest pairs; a pair's weight sums quantity products per basket.

    Pairs that cannot reach the top are left out exactly: by Cauchy-Schwarz a
    pair weighs at most sqrt(E_a * E_b), E being an item's sum of squared basket
    quantities.  A first look at the few items of largest E gives a weight the
    n-th pair certainly has, and items that cannot reach it with any partner
    are dropped before pairs are formed.  The per-basket totals are written to
    the shared folder once, since every step reads them.  The lines and the pairs
    are counted first, and their shuffles get so many partitions that what a task
    holds stays the same for tables of any size; so the n rows are made here.
    """
    spark, heaviest = lines.sparkSession, [F.desc("weight"), F.col("item_a"), F.col("item_b")]
    rows = lines.count()
    with _tasks_for(spark, rows):
        totals = materialised(item_totals(lines, basket, item, quantity), "basket-totals")
        same = _same_item(totals)
        energy = totals.groupBy("item").agg(F.sum(F.col("q") * F.col("q")).alias("e"))
        seed = energy.orderBy(F.desc("e"), "item").limit(_SEED_ITEMS + 1).collect()
        kept = totals
        if len(seed) > _SEED_ITEMS:
            chosen = totals.filter(F.col("item").isin([row["item"] for row in seed[:_SEED_ITEMS]]))
            sizes = basket_sizes(chosen)
            with _tasks_for(spark, max(rows, sizes.pairs)):
                reached = _cross_items(chosen, block_items, sizes).unionByName(same).orderBy(F.desc("weight")).limit(n)
                w, found = reached.agg(F.min("weight"), F.count(F.lit(1))).first()
            if found == n and w > 0:
                floor = (w * w / seed[0]["e"]) * (1 - 1e-9)
                kept = totals.join(energy.filter(F.col("e") >= floor).select("item"), "item", "left_semi")
        sizes = basket_sizes(kept)
        with _tasks_for(spark, max(rows, sizes.pairs)):
            weights = _cross_items(kept, block_items, sizes).unionByName(same)
            top = materialised(weights.orderBy(*heaviest).limit(n), "top-pairs")
    return top.orderBy(*heaviest)
