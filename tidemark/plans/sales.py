"""Example sales data: customers, categories, products and nested orders.

Every value is computed from a row number by hashing, so the tables are made on the
executors, are the same on every run, and any row can be computed again after a loss.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import key_number, name
from tidemark.operators.history import range_join_validity
from tidemark.operators.merge import identity_key
from tidemark.plans.harmonize import leaves
from tidemark.sources.tables import read_df, write_df

# Number of the first customer, category, product and order.
FIRST_NUMBER = 1000001
# Payment methods and value-added tax.
PAYMENT_METHODS = ("Credit Card", "Debit Card", "Cash", "Other")
VAT = "1.21"
# Percentage of rows that get a later version.
CUSTOMER_MUTATIONS = 20
PRODUCT_MUTATIONS = 20
FIRST_PRODUCT_MUTATIONS = 50

FIRST_NAMES = ("Anna", "Bram", "Chitra", "Daan", "Emma", "Farid", "Grace", "Hari", "Iris", "Jonas")
LAST_NAMES = ("Bakker", "Clark", "de Vries", "Evans", "Gupta", "Jansen", "Kumar", "Miller", "Singh", "Smit")
STREETS = ("Canal Street", "Hill Road", "Kerkstraat", "Lake View", "Market Lane", "Stationsweg")
COUNTRIES = ("US", "IN", "NL")
WORDS = ("amber", "basic", "clever", "daily", "eager", "fresh", "grand", "handy", "ideal", "jolly")
COLORS = ("Black", "Blue", "Green", "Orange", "Purple", "Red", "White", "Yellow")

MONEY = "decimal(18,2)"


def pick(salt: str, below: Column | int, *seed: Column) -> Column:
    """Whole number from 0 to below - 1, drawn by hashing ``seed``; never null, and known to be,
    so that no filter draws it a second time to see."""
    text = F.concat_ws("|", F.lit(salt), *[s.cast("string") for s in seed])
    number = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")
    return F.coalesce(F.pmod(number, below if isinstance(below, Column) else F.lit(below)), F.lit(0))


def choose(values: Sequence[str], salt: str, *seed: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (pick(salt, len(values), *seed) + 1).cast("int"))


def numbers(spark: SparkSession, rows: int) -> DataFrame:
    return spark.range(rows).withColumnRenamed("id", "n")


def _start_of(year: int) -> Column:
    return F.lit(f"{year:04d}-01-01").cast("timestamp_ntz")


def _moment_in(year: int, days: int, salt: str, *seed: Column) -> Column:
    """Second of the year after its first, drawn by hashing; never the very start."""
    seconds = pick(salt, days * 86400 - 1, *seed) + F.lit(1)
    passed = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return F.coalesce(_start_of(year) + passed, _start_of(year))  # never null, as ``pick``


def gen_customers(
    rows: DataFrame, year: int, first: int | Column = FIRST_NUMBER, mutated: int = CUSTOMER_MUTATIONS
) -> DataFrame:
    """One customer per row number ``n``; a share of them moves house later in the year."""
    n = F.col("n")

    def address(version: int) -> Column:
        return F.concat(
            pick(f"house{version}", 400, n) + F.lit(1), F.lit(" "), choose(STREETS, f"street{version}", n)
        )

    full_name = F.concat(choose(FIRST_NAMES, "first", n), F.lit(" "), choose(LAST_NAMES, "last", n))
    base = rows.select(
        n,
        F.concat(F.lit("C"), _number(first) + n).alias("customer_nr"),
        full_name.alias("name"),
        address(1).alias("address"),
        choose(COUNTRIES, "country1", n).alias("country"),
        F.concat(F.lit("c"), _number(first) + n, F.lit("@example.com")).alias("email"),
        choose(("F", "M"), "gender", n).alias("gender"),
        F.date_add(F.lit("1940-01-01").cast("date"), pick("birth", 25000, n).cast("int")).alias("birthdate"),
        _start_of(year).alias("modified_at"),
    )
    moved = base.where(pick("customer moves", 100, n) < mutated).withColumns(
        {
            "address": address(2),
            "country": choose(COUNTRIES, "country2", n),
            "modified_at": _moment_in(year, 364, "moved at", n),
        }
    )
    return base.unionByName(moved).drop("n")


def gen_categories(
    rows: DataFrame, year: int, first: int | Column = FIRST_NUMBER, parents: DataFrame | None = None
) -> DataFrame:
    """A tree of categories: row 0 is the root, others hang below an earlier one.

    ``parents`` (column ``product_category_nr``) restricts who may get children when
    categories are added to an existing tree.
    """
    n = F.col("n")
    number = _number(first) + n
    shaped = rows.select(
        n,
        F.concat(F.lit("A"), number).alias("product_category_nr"),
        F.concat(choose(WORDS, "word1", n), F.lit(" "), choose(WORDS, "word2", n)).alias("name"),
        _start_of(year).alias("modified_at"),
    )
    if parents is None:
        before = pick("parent", F.greatest(n, F.lit(1)), n)
        parent = F.when(n > 0, F.concat(F.lit("A"), _number(first) + before))
        result = shaped.withColumn("parent_nr", parent)
    else:
        result = _with_drawn(shaped, parents, "product_category_nr", "parent", "parent_nr")
    return result.select("product_category_nr", "name", "parent_nr", "modified_at")


def leaf_categories(categories: DataFrame) -> DataFrame:
    return leaves(categories, "product_category_nr", "parent_nr").select("product_category_nr")


def gen_products(
    rows: DataFrame,
    year: int,
    categories: DataFrame,
    first: int | Column = FIRST_NUMBER,
    mutated: int = PRODUCT_MUTATIONS,
) -> DataFrame:
    """One product per row number in one of ``categories``; some change color and price."""
    n = F.col("n")

    def with_tax(price: Column) -> Column:
        return (price * F.lit(VAT).cast("decimal(3,2)")).cast(MONEY)

    price = (F.lit(10) + pick("price", 79, n) * F.lit(5)).cast(MONEY)
    shaped = rows.select(
        n,
        F.concat(F.lit("P"), _number(first) + n).alias("product_nr"),
        F.concat(choose(WORDS, "adjective", n), F.lit(" product")).alias("name"),
        choose(COLORS, "color1", n).alias("color"),
        with_tax(price).alias("price"),
        price.alias("priceWithoutVAT"),
        _start_of(year).alias("modified_at"),
    )
    base = _with_drawn(shaped, categories, "product_category_nr", "category", "product_category_nr")
    change = (pick("price change", 21, n) - F.lit(10)).cast("decimal(5,0)")
    new_price = F.floor(F.col("priceWithoutVAT") * (F.lit(100) + change) / F.lit(100)).cast(MONEY)
    changed = base.where(pick("product changes", 100, n) < mutated).withColumns(
        {
            "color": choose(COLORS, "color2", n),
            "price": with_tax(new_price),
            "priceWithoutVAT": new_price,
            "modified_at": _moment_in(year, 333, "changed at", n),
        }
    )
    columns = ["product_nr", "name", "color", "product_category_nr", "price", "priceWithoutVAT", "modified_at"]
    return base.unionByName(changed).select(*columns)


def gen_order_details(
    rows: DataFrame,
    year: int,
    last_customer: int | Column,
    last_product: int | Column,
    first: int | Column = FIRST_NUMBER,
) -> DataFrame:
    """One to five detail rows per order number."""
    n, d = F.col("n"), F.col("order_detail_nr")
    customers = (_number(last_customer) - F.lit(FIRST_NUMBER - 1)).cast("bigint")
    products = (_number(last_product) - F.lit(FIRST_NUMBER - 1)).cast("bigint")
    return rows.select(
        F.concat(F.lit("O"), _number(first) + n).alias("order_nr"),
        _moment_in(year, 364, "ordered at", n).alias("ordered_at"),
        F.concat(F.lit("C"), F.lit(FIRST_NUMBER) + pick("customer", customers, n)).alias("customer_number"),
        choose(PAYMENT_METHODS, "payment", n).alias("payment_method"),
        n,
        F.explode(F.sequence(F.lit(1).cast("bigint"), pick("details", 5, n) + 1)).alias("order_detail_nr"),
    ).select(
        "order_nr", "ordered_at", "customer_number", "payment_method", "order_detail_nr",
        F.concat(F.lit("P"), F.lit(FIRST_NUMBER) + pick("product", products, n, d)).alias("product_nr"),
        (pick("amount", 5, n, d) + 1).alias("amount"),
    )


def price_details(details: DataFrame, products: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Detail rows with the price that was valid when they were ordered.

    Generated orders draw their products evenly; give ``hot_rows`` for details that do not.
    """
    versions = products.select(
        "product_nr", F.col("modified_at").alias("valid_from"), "price", "priceWithoutVAT"
    )
    return range_join_validity(
        details, versions, ["product_nr"], "ordered_at", valid_to=None, hot_rows=hot_rows
    ).drop("valid_from")


def order_rollup(priced: DataFrame, nest: bool = False) -> DataFrame:
    """Order-level counts and sums; ``OrderDistinctProductCount`` counts rows, as ever."""
    amount, price, net = F.col("amount"), F.col("price"), F.col("priceWithoutVAT")
    nested = [
        F.array_sort(
            F.collect_list(F.struct("order_detail_nr", "product_nr", "amount", "price", "priceWithoutVAT"))
        ).alias("order_details")
    ] if nest else []
    return priced.groupBy("order_nr", "ordered_at", "customer_number", "payment_method").agg(
        F.count("product_nr").alias("OrderDistinctProductCount"),
        F.sum(amount).alias("OrderTotalAmount"),
        F.sum((price * amount).cast(MONEY)).cast(MONEY).alias("OrderTotalPayableAmount"),
        F.sum((net * amount).cast(MONEY)).cast(MONEY).alias("OrderTotalPayableAmountWithoutVAT"),
        *nested,
    )


def build_orders(details: DataFrame, products: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Nested order documents. An array holds the details of one order, nothing more."""
    return order_rollup(price_details(details, products, hot_rows), nest=True)


def max_business_key(df: DataFrame, column: str, leading: int = 1) -> DataFrame:
    """One row: the largest numeric part of a key, 0 when there is none."""
    return df.agg(F.coalesce(F.max(key_number(column, leading)), F.lit(0)).alias("max_business_key"))


def last_business_key(df: DataFrame, column: str, leading: int = 1) -> int:
    return max_business_key(df, column, leading).first()[0]


def mutate_orders(
    orders: DataFrame,
    run: str,
    year: int,
    month: int,
    key: str = "order_nr",
    ordered_at: str = "ordered_at",
    customer: str = "customer_number",
    hash_key: str | None = "hash_key",
) -> DataFrame:
    """Test increments of an order table: ``first``, ``update``, ``insert``,
    ``update_insert``; anything else gives no rows.

    Updates change the customer, inserts are copies with new keys a year later, of one
    month each. New parts come from the hash of the key, so a rerun gives the same rows.
    """
    day = name(ordered_at).cast("date")
    dated = orders.withColumn(ordered_at, day)
    month_rows = dated.where((F.year(name(ordered_at)) == year) & (F.month(name(ordered_at)) == month))

    def suffix(salt: str) -> Column:
        return F.lpad(pick(salt, 10000, name(key)).cast("string"), 4, "0")

    new_customer = F.concat(name(customer).cast("string"), suffix("customer"))
    base = dated.withColumn(customer, name(customer).cast("string")).withColumn(key, name(key).cast("string"))
    updated = month_rows.withColumns({customer: new_customer, key: name(key).cast("string")})
    changes = {
        key: F.concat(name(key).cast("string"), suffix("order")),
        ordered_at: F.date_add(name(ordered_at), 365),
        customer: new_customer,
    }
    if hash_key:
        changes[hash_key] = F.md5(F.concat(name(hash_key), name(key).cast("string"), suffix("hash")))
    inserted = month_rows.withColumns(changes)
    if run == "first":
        return base
    if run == "update":
        return updated
    if run == "insert":
        return inserted
    if run == "update_insert":
        return updated.unionByName(inserted)
    return base.where(F.lit(False))


@dataclass(frozen=True)
class Sizes:
    customers: int
    categories: int
    products: int
    orders: int


def paths(root: str) -> Mapping[str, str]:
    return {t: f"{root.rstrip('/')}/{t}" for t in ("customer", "product_category", "product", "order")}


def load_initial(spark: SparkSession, root: str, year: int, sizes: Sizes) -> None:
    """Create all four tables."""
    at = paths(root)
    write_df(gen_customers(numbers(spark, sizes.customers), year), at["customer"], "overwrite")
    write_df(gen_categories(numbers(spark, sizes.categories), year), at["product_category"], "overwrite")
    leaf = leaf_categories(read_df(spark, at["product_category"]))
    write_df(
        gen_products(numbers(spark, sizes.products), year, leaf, mutated=FIRST_PRODUCT_MUTATIONS),
        at["product"], "overwrite",
    )
    details = gen_order_details(
        numbers(spark, sizes.orders), year,
        last_business_key(read_df(spark, at["customer"]), "customer_nr"),
        last_business_key(read_df(spark, at["product"]), "product_nr"),
    )
    write_df(build_orders(details, read_df(spark, at["product"])), at["order"], "overwrite")


def load_more(spark: SparkSession, root: str, year: int, sizes: Sizes) -> None:
    """Append to all four tables, numbers going on where they stopped."""
    at = paths(root)
    last = {
        t: last_business_key(read_df(spark, at[t]), column)
        for t, column in (("customer", "customer_nr"), ("product_category", "product_category_nr"),
                          ("product", "product_nr"), ("order", "order_nr"))
    }
    if sizes.customers:
        write_df(
            gen_customers(numbers(spark, sizes.customers), year, last["customer"] + 1), at["customer"], "append"
        )
    if sizes.categories:
        # Categories with products stay leaves.
        free = read_df(spark, at["product_category"]).join(
            read_df(spark, at["product"]).select("product_category_nr").distinct(),
            ["product_category_nr"], "left_anti",
        )
        write_df(
            gen_categories(numbers(spark, sizes.categories), year, last["product_category"] + 1, free),
            at["product_category"], "append",
        )
    if sizes.products:
        leaf = leaf_categories(read_df(spark, at["product_category"]))
        write_df(
            gen_products(numbers(spark, sizes.products), year, leaf, last["product"] + 1), at["product"], "append"
        )
    if sizes.orders:
        details = gen_order_details(
            numbers(spark, sizes.orders), year,
            last["customer"] + sizes.customers, last["product"] + sizes.products, last["order"] + 1,
        )
        write_df(build_orders(details, read_df(spark, at["product"])), at["order"], "append")


def order_batch(spark: SparkSession, root: str, year: int, rows: int, first: int) -> DataFrame:
    """The next orders of a running load."""
    at = paths(root)
    products = read_df(spark, at["product"])
    details = gen_order_details(
        numbers(spark, rows), year,
        last_business_key(read_df(spark, at["customer"]), "customer_nr"),
        last_business_key(products, "product_nr"),
        first,
    )
    return build_orders(details, products)


def _number(value: int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("bigint")


def _with_drawn(rows: DataFrame, pool: DataFrame, pool_key: str, salt: str, out: str) -> DataFrame:
    """Add to each row one key of ``pool``, drawn by hashing the row number."""
    members = identity_key(pool.select(name(pool_key).alias("__member")).distinct(), "__index", ["__member"])
    size = members.agg(F.count(F.lit(1))).scalar()
    drawn = rows.withColumn("__index", pick(salt, F.greatest(size, F.lit(1)), F.col("n")) + F.lit(1))
    return (
        drawn.join(members, ["__index"], "left").withColumn(out, F.col("__member")).drop("__index", "__member")
    )
