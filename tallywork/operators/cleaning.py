"""Raw text tables to typed ones, and lists in one cell to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.text import clean_list, leading_number, list_items, list_size, normalize_nulls, parse_timestamp


def clean_order_items(orders: DataFrame) -> DataFrame:
    """Tokens to NULL, blanks out of the lists, and a number for every item of an order.

    Items are numbered by product (NULL last), then by their lists. Equal items are alike, so
    they are counted first; the window sees one row per order, product and lists, and every
    count is spread again into its numbers."""
    cleaned = orders.withColumns({"exclusions": clean_list(F.col("exclusions")), "extras": clean_list(F.col("extras"))})
    alike = cleaned.groupBy(*cleaned.columns).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col("pizza_id").asc_nulls_last(), F.coalesce("exclusions", F.lit("")), F.coalesce("extras", F.lit(""))]
    last = F.sum("_n").over(Window.partitionBy("order_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    numbers = F.sequence(F.col("_last") - F.col("_n") + 1, F.col("_last"))
    return alike.withColumn("_last", last).withColumn("order_item_id", F.explode(numbers)).drop("_n", "_last")


def list_sizes(items: DataFrame) -> DataFrame:
    """Number of elements in each list of an item."""
    return items.select(
        "order_id",
        "order_item_id",
        "pizza_id",
        "exclusions",
        "extras",
        list_size(F.col("exclusions")).alias("number_of_exclusions"),
        list_size(F.col("extras")).alias("number_of_extras"),
    )


def tagged_elements(lists: dict[str, Column]) -> Column:
    """Array of (change_type, topping_id) from several text lists, tagged by their name."""

    def tagged(tag: str, cell: Column) -> Column:
        return F.transform(
            list_items(cell),
            lambda x: F.struct(F.lit(tag).alias("change_type"), x.try_cast("int").alias("topping_id")),
        )

    nothing = F.array().cast("array<struct<change_type:string,topping_id:int>>")
    return F.concat(*[F.coalesce(tagged(tag, cell), nothing) for tag, cell in lists.items()])


def order_changes(items: DataFrame, excluded: str = "Exclude", extra: str = "Extra") -> DataFrame:
    """Both lists as one long table, in a single pass over the items."""
    cells = tagged_elements({excluded: F.col("exclusions"), extra: F.col("extras")})
    return items.select("order_id", "order_item_id", F.explode(cells).alias("c")).select(
        "order_id", "order_item_id", "c.change_type", "c.topping_id"
    )


def zip_lists(items: DataFrame) -> DataFrame:
    """Both lists side by side: '' past the end of a list, NULL where there is none."""
    longest = F.greatest(list_size(F.col("exclusions")), list_size(F.col("extras")))
    steps = items.filter(longest.isNotNull()).withColumn("change_index", F.explode(F.sequence(F.lit(1), longest)))
    comma = F.lit(",")
    return steps.select(
        "order_id",
        "order_item_id",
        "change_index",
        F.split_part("exclusions", comma, "change_index").alias("exclusion_id"),
        F.split_part("extras", comma, "change_index").alias("extras_id"),
    )


def clean_deliveries(raw: DataFrame) -> DataFrame:
    """Units out of the text, tokens to NULL, texts to timestamp and numbers."""
    return raw.select(
        "order_id",
        "runner_id",
        parse_timestamp(F.col("pickup_time")).alias("pickup_time"),
        leading_number(F.col("distance")).alias("distance"),
        leading_number(F.col("duration")).alias("duration"),
        normalize_nulls(F.col("cancellation")).alias("cancellation"),
    )


def recipe_rows(recipes: DataFrame, keep: Sequence[str] = ("pizza_id",)) -> DataFrame:
    """Text lists of topping ids to one row per recipe and topping.

    Any run of commas and blanks separates two ids."""
    ids = F.split(F.trim("toppings"), r"[,\s]+")
    return recipes.select(*keep, F.explode(ids).alias("_id")).select(*keep, F.col("_id").try_cast("int").alias("topping_id"))
