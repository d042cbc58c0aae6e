"""Baskets: per-transaction totals, shares, penetration and common baskets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.numbers import percent, ratio
from tallywork.operators.recipes import joined_text
from tallywork.sources.tables import cut_lineage


def revenue() -> Column:
    return F.col("qty") * F.col("price")


def per_transaction(lines: DataFrame, *extra: str) -> DataFrame:
    """One row per transaction and discount: quantity and revenue before the discount.

    The discount is repeated on every line of a transaction and counts once."""
    return lines.groupBy("txn_id", "discount", *extra).agg(
        F.sum("qty").alias("qty"), F.sum(revenue()).alias("revenue"), F.count(F.lit(1)).alias("lines")
    )


def sales_totals(lines: DataFrame) -> DataFrame:
    return per_transaction(lines).agg(
        F.sum("qty").alias("total_qty"),
        F.sum("revenue").alias("total_revenue_no_discount"),
        F.sum("discount").alias("discount"),
    )


def transactions(lines: DataFrame) -> Column:
    """Number of transactions, as a scalar."""
    return lines.agg(F.countDistinct("txn_id")).scalar()


def member_split(lines: DataFrame, member: str) -> DataFrame:
    """Share of the discounted revenue and mean revenue per member flag."""
    sums = per_transaction(lines, member).groupBy(member).agg(
        (F.sum("revenue") - F.sum("discount")).alias("r"), F.count(F.lit(1)).alias("n")
    )
    whole = sums.agg(F.sum("r")).scalar()
    return sums.select(
        member,
        percent(F.col("r"), whole, 2).alias("total_revenue_pct"),
        ratio(F.col("r"), F.col("n"), 2).alias("avg_member_revenue"),
    )


def penetration(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines and transactions of every product against the number of transactions."""
    counts = lines.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("product_lines"), F.countDistinct("txn_id").alias("product_transactions")
    )
    whole = transactions(lines)
    return counts.join(products.select("product_id", "product_name"), "product_id").withColumns(
        {
            "line_penetration": ratio(F.col("product_lines"), whole, 6),
            "penetration": ratio(F.col("product_transactions"), whole, 6),
        }
    )


def basket_texts(lines: DataFrame, products: DataFrame, at_least: int) -> DataFrame:
    """The distinct item names of every transaction with enough of them, in one text.

    Names are made distinct before they are joined to a text, which therefore never
    holds more than the catalogue."""
    names = (
        lines.join(products.select("product_id", "product_name"), "product_id").select("txn_id", "product_name").distinct()
    )
    baskets = names.groupBy("txn_id").agg(
        joined_text("product_name", ", ", "product_name").alias("product_combi"), F.count(F.lit(1)).alias("items")
    )
    return baskets.filter(F.col("items") >= at_least)


#: Items from which a transaction is wide: its pairs are not listed, but looked up.
WIDE = 100
#: Most frequent pairs that the search starts with.
FIRST_PAIRS = 10_000


def pairs_of(rows: DataFrame) -> DataFrame:
    """(txn_id, a, b) of every two items, a < b, of a transaction."""
    other = rows.select("txn_id", F.col("item").alias("b"))
    return rows.select("txn_id", F.col("item").alias("a")).join(other, "txn_id").filter("a < b")


def looked_up(pairs: DataFrame, wide: DataFrame) -> DataFrame:
    """(txn_id, a, b) of the given pairs in wide transactions."""
    first = wide.select("txn_id", F.col("item").alias("a"))
    second = wide.select("txn_id", F.col("item").alias("b"))
    return pairs.select("a", "b").join(first, "a").join(second, ["txn_id", "b"]).select("txn_id", "a", "b")


def counted(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def pair_counts(narrow: DataFrame, wide: DataFrame, several_wide: bool) -> DataFrame:
    """(a, b, n): pairs of items, a < b, in two transactions or more.

    Pairs are listed in narrow transactions only. Those that a narrow one has are looked up in the
    wide ones; a pair of wide ones alone counts if at least two share it, and is listed from the
    items that two wide ones have."""
    counts = counted(pairs_of(narrow), "a", "b")
    parts = counts.unionByName(counted(looked_up(counts, wide), "a", "b"))
    if several_wide:
        shared = counted(wide, "item").filter("n > 1").select("item")
        parts = parts.unionByName(counted(pairs_of(wide.join(shared, "item", "left_semi")), "a", "b").join(counts, ["a", "b"], "left_anti"))
    return parts.groupBy("a", "b").agg(F.sum("n").alias("n")).filter("n > 1")


def occurrences(pairs: DataFrame, narrow: DataFrame, wide: DataFrame) -> DataFrame:
    """(txn_id, a, b) of the given pairs in all transactions."""
    return pairs_of(narrow).join(pairs, ["a", "b"], "left_semi").select("txn_id", "a", "b").unionByName(looked_up(pairs, wide))


def next_level(level: DataFrame, pairs: DataFrame) -> DataFrame:
    """(txn_id, items) one item larger: two sets of a transaction that differ in their last item
    only, if their last items are a pair of the transaction too."""
    head, last = F.slice("items", 1, F.size("items") - 1), F.element_at("items", -1)
    left = level.select("txn_id", head.alias("head"), last.alias("a"))
    right = left.withColumnRenamed("a", "b")
    both = left.join(right, ["txn_id", "head"]).filter("a < b").join(pairs, ["txn_id", "a", "b"], "left_semi")
    return both.select("txn_id", F.concat("head", F.array("a", "b")).alias("items"))


def frequent_sets(lines: DataFrame, products: DataFrame, size: int, wide: int = WIDE) -> DataFrame:
    """Item sets of one size (2 or more) with the number of their transactions; always the most
    frequent ones.

    Level by level: items of two transactions or more, pairs of them, sets of three whose pairs are
    all frequent, and so on, counted by a join per level and bounded at ``size``. No set is more
    frequent than its rarest pair, so the search starts with the most frequent pairs and ends when the best set found is more frequent than every pair not yet taken. The next
    bound is the best count so far, or half the last bound. A transaction with very many items lists
    no pairs of its own. Where no set is in two transactions, all are equally frequent: each
    transaction gives its first by name."""
    known = products.groupBy("product_name").agg(F.min("product_id").alias("item"))  # products of one name are one item
    item_of = products.join(known, "product_name").select("product_id", "item")
    names = cut_lineage(lines.join(item_of, "product_id").select("txn_id", "item").distinct())
    wide_ids = cut_lineage(counted(names, "txn_id").filter(F.col("n") > wide).select("txn_id"))
    narrow, large = names.join(wide_ids, "txn_id", "left_anti"), names.join(wide_ids, "txn_id", "left_semi")
    pairs = cut_lineage(pair_counts(narrow, large, wide_ids.count() > 1))
    top = pairs.orderBy(F.col("n").desc()).limit(FIRST_PAIRS).agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("rows")).first()
    bound = top["n"] if top["rows"] >= size * (size - 1) // 2 else 0
    while bound > 1:
        pairs_in = cut_lineage(occurrences(pairs.filter(F.col("n") >= bound), narrow, large))
        level = pairs_in.select("txn_id", F.array("a", "b").alias("items"))
        for _ in range(size - 2):
            level = next_level(level, pairs_in)
        counts = cut_lineage(counted(level, "items"))
        best = counts.agg(F.max("n").alias("n")).first()["n"] or 0
        # A set not counted yet has a rarer pair, so it is no more frequent than the best of those.
        rarer = pairs.filter(F.col("n") < bound).agg(F.max("n").alias("n")).first()["n"] or 0
        if best > max(1, rarer) or best >= bound:
            return named(counts.filter(F.col("n") == best), known)
        bound = min(max(best, bound // 2), rarer)
    return named(first_of_each(names.join(known, "item"), size).distinct().withColumn("n", F.lit(1).cast("bigint")), known)


def first_of_each(names: DataFrame, size: int) -> DataFrame:
    """Each transaction's first items in the order of their text, if it has so many."""
    rank = F.row_number().over(Window.partitionBy("txn_id").orderBy(F.concat("product_name", F.lit(", "))))
    first = names.withColumn("_rank", rank).filter(F.col("_rank") <= size)
    lists = first.groupBy("txn_id").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return lists.filter(F.size("items") == size).select("items")


def named(counts: DataFrame, known: DataFrame) -> DataFrame:
    """The sets' names in one text, in their order."""
    rows = counts.select("items", "n", F.explode("items").alias("item")).join(known, "item")
    texts = rows.groupBy("items").agg(F.array_join(F.array_sort(F.collect_list("product_name")), ", ").alias("product_combi"), F.max("n").alias("transactions"))
    return texts.select("product_combi", "transactions")


def report(lines: DataFrame, products: DataFrame, period: str, member: str) -> DataFrame:
    """The figures of a study per period: sums, transactions, discounts, baskets, the members'
    share of revenue and the product with the largest revenue (ties by name)."""
    is_member = F.col("flag") == member
    sums = lines.groupBy(period, "txn_id").agg(
        F.sum("qty").alias("q"), F.sum(revenue()).alias("r"), F.sum(F.when(is_member, revenue()).otherwise(0)).alias("mr"), F.count(F.lit(1)).alias("n")
    )
    totals = sums.groupBy(period).agg(
        F.sum("q").alias("total_qty"), F.sum("r").alias("r"), F.sum("mr").alias("mr"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("transactions")
    )
    given = lines.select(period, "txn_id", "discount").distinct().groupBy(period).agg(F.sum("discount").alias("d"), F.count(F.lit(1)).alias("dn"))
    sold = lines.groupBy(period, "product_id").agg(F.sum(revenue()).alias("pr"))
    kinds = sold.groupBy(period).agg(F.count("product_id").alias("products"))
    named = sold.join(products.select("product_id", "product_name"), "product_id").groupBy(period, "product_name").agg(F.sum("pr").alias("pr"))
    best = named.groupBy(period).agg(F.min_by("product_name", F.struct((-F.col("pr")).alias("r"), "product_name")).alias("top_product"))
    joined = totals.join(given, period).join(kinds, period).join(best, period, "left")
    return joined.select(
        period, "total_qty", F.col("r").alias("total_revenue"), "transactions", "products", F.col("d").alias("total_discount"),
        ratio(F.col("d"), F.col("dn"), 4).alias("avg_discount"), ratio(F.col("n"), F.col("transactions"), 2).alias("avg_txn_product_count"),
        percent(F.col("mr"), F.col("r"), 2).alias("member_revenue_pct"), "top_product",
    )
