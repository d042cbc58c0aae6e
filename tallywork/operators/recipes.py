"""Order items against recipes: labels, ingredient lists and totals, prices.

Texts are built once for each different combination of lists: its ids are exploded,
named by a join and put together again, and the items join the finished texts. A
topping table of any size, with repeated or missing ids, takes the same way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions.text import list_ids
from tallywork.operators.cleaning import tagged_elements
from tallywork.operators.skew import join_on



def joined_text(text: Column | str, sep: str, order: str) -> Column:
    """Ordered string aggregate; NULLs are skipped."""
    return F.expr(f"listagg({text}, '{sep}') within group (order by {order})")


def item_labels(items: DataFrame, names: DataFrame, toppings: DataFrame) -> DataFrame:
    """``Name - Exclude: A, B - Extra: C`` for every item.

    An id that stands twice in the topping table gives both its names; a row without id none."""
    columns = {"Exclude": "exclusions", "Extra": "extras"}
    lists = list(columns.values())
    changed = F.greatest(*[F.col(c).isNotNull() for c in lists])
    cells = tagged_elements({t: F.col(c) for t, c in columns.items()})
    combos = items.filter(changed).select(*lists).distinct()
    changes = combos.select(*lists, F.explode_outer(cells).alias("c")).select(*lists, "c.change_type", "c.topping_id")
    texts = changes.join(toppings, "topping_id", "left").groupBy(*lists).agg(
        *[
            joined_text(f"case when change_type = '{t}' then topping_name end", ", ", "topping_name").alias(t)
            for t in columns
        ]
    )
    parts = [F.coalesce(F.concat(F.lit(f" - {t}: "), F.col(t)), F.lit("")) for t in columns]
    labelled = join_on(items, texts, lists, "left").join(names.select("pizza_id", "pizza_name"), "pizza_id")
    return labelled.select("order_id", "order_item_id", F.concat("pizza_name", *parts).alias("order_string"))


def ingredients(combos: DataFrame, keep: list[str]) -> DataFrame:
    """Toppings of a recipe with changes as an array ``used`` and those that count twice as
    ``doubled``: an extra that is on the recipe anyway. An extra wins over an exclusion
    of the same topping."""
    sets = combos.withColumns(
        {
            "_recipe": list_ids(F.col("toppings")),
            "_without": list_ids(F.col("exclusions")),
            "_with": list_ids(F.col("extras")),
        }
    )
    kept = F.array_except("_recipe", F.array_except("_without", "_with"))
    return sets.select(
        *keep, F.array_union(kept, F.col("_with")).alias("used"), F.array_intersect("_recipe", "_with").alias("doubled")
    )


def ingredient_lists(items: DataFrame, recipes: DataFrame, names: DataFrame, toppings: DataFrame) -> DataFrame:
    """Ingredients of every item as one text in alphabetical order."""
    lists = ["toppings", "exclusions", "extras"]
    full = items.join(recipes.select("pizza_id", "toppings"), "pizza_id")
    combos = full.select(*lists).distinct()
    used = ingredients(combos, lists)
    rows = used.select(*lists, "doubled", F.explode_outer("used").alias("topping_id"))
    twice = F.array_contains("doubled", F.col("topping_id"))
    named = rows.withColumn("twice", twice).join(toppings, "topping_id", "left")
    word = "case when twice then '2x' || topping_name else topping_name end"
    texts = named.groupBy(*lists).agg(joined_text(word, ", ", "topping_name").alias("ingredients"))
    labelled = join_on(full, texts, lists, "left").join(names.select("pizza_id", "pizza_name"), "pizza_id")
    return labelled.select("order_id", "order_item_id", "pizza_name", "ingredients")


def ingredient_totals(items: DataFrame, recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """Quantity of every ingredient over all items: items are counted per product and
    lists, products then per recipe, before any array is built."""
    lists = ["toppings", "exclusions", "extras"]
    counts = items.groupBy("pizza_id", "exclusions", "extras").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.join(recipes.select("pizza_id", "toppings"), "pizza_id").groupBy(*lists).agg(F.sum("n").alias("n"))
    rows = ingredients(counts, ["n"]).select("n", "doubled", F.explode("used").alias("topping_id"))
    quantity = F.when(F.array_contains("doubled", F.col("topping_id")), 2).otherwise(1)
    totals = rows.groupBy("topping_id").agg(F.sum(quantity * F.col("n")).alias("ingredient_count"))
    return totals.join(toppings, "topping_id").select("topping_name", "ingredient_count")


def shared_members(rows: DataFrame, group: str, member: str, first: str, second: str) -> DataFrame:
    """Members that both groups have."""
    one = rows.filter(F.col(group) == first).select(member)
    other = rows.filter(F.col(group) == second).select(member)
    return one.intersect(other)


def extras_charge(items: DataFrame, toppings: DataFrame, dear: str, dear_price: int, price: int) -> DataFrame:
    """One row: what all extras cost, one named topping at its own price."""
    ids = items.select(F.explode(list_ids(F.col("extras"))).alias("topping_id")).groupBy("topping_id").count()
    fee = F.when(F.col("topping_name") == dear, dear_price).otherwise(price)
    return ids.join(toppings, "topping_id").agg(F.coalesce(F.sum(F.col("count") * fee), F.lit(0)).alias("charge"))


def set_where(df: DataFrame, column: str, condition: Column, value: Column) -> DataFrame:
    """Overwrite a column where the condition holds."""
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def add_product(menu: DataFrame, recipe: DataFrame, toppings: DataFrame, pizza_id: int, name: str, price: float):
    """Append a product that carries every topping; returns (menu, recipe rows)."""
    row = toppings.sparkSession.range(1).select(
        F.lit(pizza_id).cast("bigint").alias("pizza_id"), F.lit(name).alias("pizza_name"), F.lit(price).alias("price")
    )
    rows = toppings.select(F.col("topping_id").cast("int").alias("topping_id")).withColumn(
        "pizza_id", F.lit(pizza_id).cast("bigint")
    )
    return menu.unionByName(row), recipe.unionByName(rows)
