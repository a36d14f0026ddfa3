"""Mixing sources to target weights by hierarchical budgeting.

A token budget moves down a tree of levels (for example domain, language, source). A node's budget is dealt to its
children by weight; a child cannot take more than it holds (its tokens times the allowed epochs), and what
it leaves goes to its siblings by weight. Only what no sibling can take is missing further up, where the parent
was already counted with what its children hold together. Each leaf then takes whole epochs and a prefix of
one more: its documents in an order seeded by the epoch, as long as the sum of tokens stays within
the leaf's budget.

Tokens are words ``[^ \\t-\\r]+``. Null texts have none; null levels count as ''. A null id is an id. Rows with
equal ids are ordered by tokens and a hash of the text; rows equal in all of that are interchangeable.
A document without tokens is taken where the prefix reaches it. A weight of 0 or less, or null, takes nothing.
An empty table gives an empty result. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.operators.joins import salted_join

WORDS = r"[^ \t-\r]+"
SPREAD = 16  # a leaf's rows meet its plan in so many tasks


def n_tokens(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def deal(children: DataFrame, parent: Sequence[str], key: str) -> DataFrame:
    """``share`` per child from the parent's ``allotted``: by weight, never above ``capacity``.

    Children are taken by capacity per weight. While a child's capacity is below its part of what is
    left, it takes all; from the first one on that is not, all take the same tokens per weight, the largest
    quotient that such a child sees.
    """
    usable = F.when(F.col("weight") > 0, F.col("weight")).otherwise(F.lit(0.0))
    ratio = F.when(usable > 0, F.col("capacity") / usable).otherwise(F.lit(float("inf")))
    group = Window.partitionBy(*parent)
    order = group.orderBy("_ratio", key)
    left = F.col("allotted") - F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing))
    table = children.withColumn("_w", usable).withColumn("_ratio", ratio).withColumn("_left", left).withColumn(
        "_weight_left", weight_left)
    level = F.max(F.when((F.col("_w") > 0) & (F.col("capacity") * F.col("_weight_left") > F.col("_left") * F.col("_w")),
                         F.col("_left") / F.col("_weight_left"))).over(group)
    return table.withColumn("_level", level).withColumn("share", F.when(F.col("_w") <= 0, 0.0).when(
        F.col("_level").isNull(), F.col("capacity").cast("double")).otherwise(
        F.least(F.col("capacity").cast("double"), F.col("_w") * F.col("_level")))).drop(
        "_w", "_ratio", "_left", "_weight_left", "_level")


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Sequence[Column], budget: Column, epochs: int) -> DataFrame:
    """(levels..., supply, leaf_budget): token budgets of the leaves; ``leaves`` has the levels and ``supply``.

    ``weights`` gives, per level, a node's weight among its siblings from the level columns down to it.
    ``budget`` is an aggregate over the leaves, such as a literal or a share of all supply.
    """
    # A leaf below a node that takes nothing holds nothing for the nodes above, so that their siblings get its part.
    usable = reduce(lambda a, b: a & b, (w.cast("double") > 0 for w in weights))
    rows = leaves.withColumn("capacity", F.when(usable, F.col("supply") * epochs).otherwise(0))
    tables = [rows.groupBy(*levels[:d]).agg(F.sum("capacity").alias("capacity")) for d in range(1, len(levels) + 1)]
    root = rows.agg(F.least(F.sum("capacity").cast("double"), budget.cast("double")).alias("allotted"))
    above, parent = root, []
    for depth, table in enumerate(tables):
        keys = list(levels[:depth + 1])
        joined = table.crossJoin(F.broadcast(above)) if not parent else table.join(above, parent)  # the root is one row
        dealt = deal(joined.withColumn("weight", weights[depth].cast("double")), parent or [F.lit(0)], keys[-1])
        above, parent = dealt.select(*keys, F.col("share").alias("allotted")), keys
    return leaves.join(above, list(levels)).select(
        *levels, "supply", F.floor(F.col("allotted") + 1e-6).cast("bigint").alias("leaf_budget"))


def mix(docs: DataFrame, levels: dict[str, Column], weights: Sequence[Column], budget: Column, epochs: int, seed: int = 17,
        id_col: str = "doc_id", text_col: str = "text", buckets: int = 3) -> DataFrame:
    """The chosen rows with their level columns, ``n_tokens`` and ``copies`` (how often the row is taken), which replace columns of
    those names.

    A leaf of any size is summed in two steps: per bucket of the seeded order (``buckets`` hex digits), then
    within a bucket. Only ids, levels and sums are shuffled for that, not texts.
    """
    names = list(levels)
    keyed = docs.select(*(F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()), n_tokens(text_col).alias("n_tokens"),
                        F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text_hash"),
                        *(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns)))  # unused ones are not read
    leaves = keyed.groupBy(*names).agg(F.sum("n_tokens").alias("supply"))
    plan = budgets(leaves, names, weights, budget, epochs).withColumn(
        "_epochs", F.when(F.col("supply") > 0, F.floor(F.col("leaf_budget") / F.col("supply"))).otherwise(0).cast("bigint")
    ).withColumn("_rest", F.col("leaf_budget") - F.col("_epochs") * F.col("supply")).drop("supply", "leaf_budget")
    placed = salted_join(keyed, plan, names, "inner", ["_id"], SPREAD)
    seeded = F.md5(F.concat_ws("|", F.lit(seed).cast("string"), F.col("_epochs").cast("string"),
                               F.coalesce(F.col("_id").cast("string"), F.lit("null"))))
    placed = placed.withColumn("_key", seeded).withColumn("_bucket", F.substring("_key", 1, buckets))
    sums = placed.groupBy(*names, "_bucket").agg(F.sum("n_tokens").alias("_sum"))
    before = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*names, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*names, "_bucket").orderBy("_key", "n_tokens", "_text_hash").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    taken = placed.join(sums, [*names, "_bucket"]).withColumn("_sum", F.col("_before") + F.sum("n_tokens").over(inside))
    copies = F.col("_epochs") + (F.col("_sum") <= F.col("_rest")).cast("bigint")
    kept = [F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in (*names, "n_tokens", "copies")]
    return taken.withColumn("copies", copies).filter("copies > 0").select(*kept, *names, "n_tokens", "copies")
