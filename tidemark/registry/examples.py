"""Example-data jobs, numbered by the rows of the given tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import name
from tidemark.plans import sales
from tidemark.registry.base import query, table
from tidemark.session import shared_dir
from tidemark.sources.tables import read_df

YEAR = 2023


def pick(salt, below, *seed):
    text = " || '|' || ".join([f"'{salt}'", *seed])
    return f"(cast('0x' || substr(md5({text}), 1, 12) as bigint) % {below})"


def choose(values, salt, *seed):
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{pick(salt, len(values), *seed)} + 1]"


def numbered(spark, d, source, key):
    """Row numbers to generate from. They are cheap to move and what is computed from them
    is not, so they are spread over all cores first."""
    return table(spark, d, source).select(name(key).alias("n")).repartition(spark.sparkContext.defaultParallelism)


def numbers_of(source):
    return f"(select unnest(range((select count(*) from {source}))) as n)"


def customer_sql(rows="(select c_custkey as n from customer)", year=YEAR, first=sales.FIRST_NUMBER):
    def address(v):
        return f"({pick(f'house{v}', 400, 'n')} + 1) || ' ' || {choose(sales.STREETS, f'street{v}', 'n')}"

    moved_at = f"timestamp '{year}-01-01' + to_seconds({pick('moved at', 364 * 86400 - 1, 'n')} + 1)"
    return f"""
        with base as (
            select n, 'C' || ({first} + n) as customer_nr,
                {choose(sales.FIRST_NAMES, 'first', 'n')} || ' ' || {choose(sales.LAST_NAMES, 'last', 'n')} as name,
                {address(1)} as address, {choose(sales.COUNTRIES, 'country1', 'n')} as country,
                'c' || ({first} + n) || '@example.com' as email, {choose(('F', 'M'), 'gender', 'n')} as gender,
                cast(date '1940-01-01' + {pick('birth', 25000, 'n')}::int as date) as birthdate,
                timestamp '{year}-01-01' as modified_at from {rows})
        select * exclude (n) from base
        union all
        select customer_nr, name, {address(2)}, {choose(sales.COUNTRIES, 'country2', 'n')}, email, gender, birthdate, {moved_at}
        from base where {pick('customer moves', 100, 'n')} < {sales.CUSTOMER_MUTATIONS}"""


@query("gen_customers", customer_sql())
def gen_customers(spark, d):
    return sales.gen_customers(numbered(spark, d, "customer", "c_custkey"), YEAR)


CATEGORIES = f"""
    select 'A' || ({sales.FIRST_NUMBER} + n) as product_category_nr,
        {choose(sales.WORDS, 'word1', 'n')} || ' ' || {choose(sales.WORDS, 'word2', 'n')} as name,
        case when n > 0 then 'A' || ({sales.FIRST_NUMBER} + {pick('parent', 'greatest(n, 1)', 'n')}) end as parent_nr,
        timestamp '{YEAR}-01-01' as modified_at from (select s_suppkey as n from supplier)
"""


@query("gen_categories", CATEGORIES)
def gen_categories(spark, d):
    return sales.gen_categories(numbered(spark, d, "supplier", "s_suppkey"), YEAR)


LEAVES = f"""
    with categories as ({CATEGORIES})
    select product_category_nr from categories c where not exists (
        select 1 from categories p where p.parent_nr = c.product_category_nr)
"""


@query("leaf_categories", LEAVES)
def leaf_categories(spark, d):
    return sales.leaf_categories(gen_categories(spark, d))


def product_versions(leaves, rows="(select p_partkey as n from part)", year=YEAR, first=sales.FIRST_NUMBER, mutated=sales.PRODUCT_MUTATIONS):
    """Products of the categories that ``leaves`` selects."""
    return f"""
    with members as (select product_category_nr, row_number() over (order by product_category_nr) as i from ({leaves})),
    base as (
        select n, 'P' || ({first} + n) as product_nr, {choose(sales.WORDS, 'adjective', 'n')} || ' product' as name,
            {choose(sales.COLORS, 'color1', 'n')} as color, product_category_nr,
            cast(10 + {pick('price', 79, 'n')} * 5 as decimal(18,2)) as net, timestamp '{year}-01-01' as modified_at
        from {rows} join members on i = {pick('category', '(select count(*) from members)', 'n')} + 1)
    select * from base union all
    select n, product_nr, name, {choose(sales.COLORS, 'color2', 'n')}, product_category_nr,
        cast(floor(net * (100 + {pick('price change', 21, 'n')} - 10) / 100) as decimal(18,2)),
        timestamp '{year}-01-01' + to_seconds({pick('changed at', 333 * 86400 - 1, 'n')} + 1)
    from base where {pick('product changes', 100, 'n')} < {mutated}"""


PRODUCTS = f"with versions as ({product_versions(LEAVES)})"


@query(
    "gen_products",
    PRODUCTS + """select product_nr, name, color, product_category_nr, cast(cast(net * 1.21 as decimal(18,2)) as double) as price,
        cast(net as double) as priceWithoutVAT, modified_at from versions""",
)
def gen_products(spark, d):
    products = products_of(spark, d)
    return products.withColumns({c: name(c).cast("double") for c in ("price", "priceWithoutVAT")})


def products_of(spark, d):
    return sales.gen_products(numbered(spark, d, "part", "p_partkey"), YEAR, leaf_categories(spark, d))


def detail_rows(rows="(select o_orderkey as n from orders)", year=YEAR, first=sales.FIRST_NUMBER,
                customers="(select count(*) from customer)", products="(select count(*) from part)"):
    return f"""
    select 'O' || ({first} + n) as order_nr,
        timestamp '{year}-01-01' + to_seconds({pick('ordered at', 364 * 86400 - 1, 'n')} + 1) as ordered_at,
        'C' || ({sales.FIRST_NUMBER} + {pick('customer', customers, 'n')}) as customer_number,
        {choose(sales.PAYMENT_METHODS, 'payment', 'n')} as payment_method, k as order_detail_nr,
        'P' || ({sales.FIRST_NUMBER} + {pick('product', products, 'n', 'k')}) as product_nr,
        {pick('amount', 5, 'n', 'k')} + 1 as amount
    from (select n, unnest(generate_series(1, {pick('details', 5, 'n')} + 1)) as k from {rows})"""


DETAILS = detail_rows()


@query("gen_order_details", DETAILS)
def gen_order_details(spark, d):
    return details_of(spark, d)


def details_of(spark, d):
    last = {
        t: table(spark, d, t).agg(F.count(F.lit(1)) + F.lit(sales.FIRST_NUMBER - 1)).scalar() for t in ("customer", "part")
    }
    return sales.gen_order_details(numbered(spark, d, "orders", "o_orderkey"), YEAR, last["customer"], last["part"])


@query(
    "build_orders",
    PRODUCTS + f""", priced as (
        select o.*, cast(net * 1.21 as decimal(18,2)) as price, net from ({DETAILS}) o
        asof join versions v on o.product_nr = v.product_nr and o.ordered_at >= v.modified_at)
    select order_nr, ordered_at, customer_number, payment_method, count(*) as OrderDistinctProductCount,
        cast(sum(amount) as bigint) as OrderTotalAmount, cast(sum(price * amount) as double) as OrderTotalPayableAmount,
        cast(sum(net * amount) as double) as OrderTotalPayableAmountWithoutVAT,
        string_agg(order_detail_nr || ':' || product_nr || ':' || amount, ',' order by order_detail_nr) as details
    from priced group by 1, 2, 3, 4""",
)
def build_orders(spark, d):
    orders = sales.build_orders(details_of(spark, d), products_of(spark, d))
    text = F.transform("order_details", lambda x: F.concat_ws(":", x["order_detail_nr"], x["product_nr"], x["amount"]))
    amounts = ("OrderTotalPayableAmount", "OrderTotalPayableAmountWithoutVAT")
    return orders.withColumn("details", F.array_join(text, ",")).drop("order_details").withColumns(
        {c: name(c).cast("double") for c in amounts}
    )


# What the loads are sized by: rows of the given tables.
FIRST_LOAD = {"customer": "customer", "category": "supplier", "product": "part", "order": "orders"}
NEXT_LOAD = {"customer": "supplier", "category": "nation", "product": "supplier", "order": "customer"}
ROW_TEXT = """
    select 'customer' as table_name, customer_nr as key, modified_at as at,
        concat_ws('|', name, address, country, email, gender, cast(birthdate as varchar)) as row_text from customers
    union all select 'product_category', product_category_nr, modified_at, concat_ws('|', name, parent_nr) from categories
    union all select 'product', product_nr, modified_at, concat_ws('|', name, color, product_category_nr,
        cast(cast(net * 1.21 as decimal(18,2)) as varchar), cast(net as varchar)) from versions
    union all select 'order', order_nr, ordered_at, concat_ws('|', customer_number, payment_method, cast(count(*) as varchar),
        cast(sum(amount) as varchar), cast(cast(sum(cast(net * 1.21 as decimal(18,2)) * amount) as decimal(18,2)) as varchar),
        cast(cast(sum(net * amount) as decimal(18,2)) as varchar),
        string_agg(order_detail_nr || ':' || product_nr || ':' || amount, ',' order by order_detail_nr))
    from (select o.*, net from details o asof join versions v on o.product_nr = v.product_nr and o.ordered_at >= v.modified_at)
    group by order_nr, ordered_at, customer_number, payment_method
"""


def rows_in(source):
    return f"(select count(*) from {source})"


LOADED = f"""
    customers1 as ({customer_sql(numbers_of('customer'))}),
    categories1 as ({CATEGORIES}),
    versions1 as ({product_versions(
        'select product_category_nr from categories1 c where not exists (select 1 from categories1 p where p.parent_nr = c.product_category_nr)',
        numbers_of('part'), mutated=sales.FIRST_PRODUCT_MUTATIONS)}),
    details1 as ({detail_rows(numbers_of('orders'))})
"""
FIRST_ONLY = ", ".join(f"{t} as (select * from {t}1)" for t in ("customers", "categories", "versions", "details"))
AFTER = {k: f"({sales.FIRST_NUMBER} + {rows_in(v)})" for k, v in FIRST_LOAD.items()}
LOADED_MORE = f"""
    customers2 as ({customer_sql(numbers_of('supplier'), YEAR + 1, AFTER['customer'])}),
    free as (
        select product_category_nr, row_number() over (order by product_category_nr) as i from categories1
        where product_category_nr not in (select product_category_nr from versions1)),
    categories2 as (
        select 'A' || ({AFTER['category']} + n) as product_category_nr,
            {choose(sales.WORDS, 'word1', 'n')} || ' ' || {choose(sales.WORDS, 'word2', 'n')} as name,
            free.product_category_nr as parent_nr, timestamp '{YEAR + 1}-01-01' as modified_at
        from {numbers_of('nation')} left join free on i = {pick('parent', '(select greatest(count(*), 1) from free)', 'n')} + 1),
    categories as (select * from categories1 union all select * from categories2),
    versions2 as ({product_versions(
        'select product_category_nr from categories c where not exists (select 1 from categories p where p.parent_nr = c.product_category_nr)',
        numbers_of('supplier'), YEAR + 1, AFTER['product'])}),
    details2 as ({detail_rows(
        numbers_of('customer'), YEAR + 1, AFTER['order'],
        f"({rows_in('customer')} + {rows_in('supplier')})", f"({rows_in('part')} + {rows_in('supplier')})")}),
    customers as (select * from customers1 union all select * from customers2),
    versions as (select * from versions1 union all select * from versions2),
    details as (select * from details1 union all select * from details2)
"""


def sizes(spark, d, load):
    counted = {k: table(spark, d, t).count() for k, t in load.items()}
    return sales.Sizes(counted["customer"], counted["category"], counted["product"], counted["order"])


def loaded_rows(spark, root):
    """All rows of the four tables, as text."""
    at = {t: read_df(spark, p) for t, p in sales.paths(root).items()}
    details = F.transform("order_details", lambda x: F.concat_ws(":", x["order_detail_nr"], x["product_nr"], x["amount"]))
    texts = {
        "customer": ("customer_nr", "modified_at", ["name", "address", "country", "email", "gender", F.col("birthdate").cast("string")]),
        "product_category": ("product_category_nr", "modified_at", ["name", "parent_nr"]),
        "product": ("product_nr", "modified_at", ["name", "color", "product_category_nr", F.col("price").cast("string"), F.col("priceWithoutVAT").cast("string")]),
        "order": ("order_nr", "ordered_at", [
            "customer_number", "payment_method", *[F.col(c).cast("string") for c in (
                "OrderDistinctProductCount", "OrderTotalAmount", "OrderTotalPayableAmount", "OrderTotalPayableAmountWithoutVAT")],
            F.array_join(details, ",")]),
    }
    found = [
        at[t].select(F.lit(t).alias("table_name"), name(key).alias("key"), name(time).alias("at"), F.concat_ws("|", *parts).alias("row_text"))
        for t, (key, time, parts) in texts.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query("load_initial", f"with {LOADED}, {FIRST_ONLY} {ROW_TEXT}")
def load_initial(spark, d):
    """First load of all four tables, sized by the given ones."""
    root = shared_dir(spark, "sales")
    sales.load_initial(spark, root, YEAR, sizes(spark, d, FIRST_LOAD))
    return loaded_rows(spark, root)


@query("load_more", f"with {LOADED}, {LOADED_MORE} {ROW_TEXT}")
def load_more(spark, d):
    """All four tables after a second load, numbers going on after the first."""
    root = shared_dir(spark, "sales")
    sales.load_initial(spark, root, YEAR, sizes(spark, d, FIRST_LOAD))
    sales.load_more(spark, root, YEAR + 1, sizes(spark, d, NEXT_LOAD))
    return loaded_rows(spark, root)


ORDER_ROWS = "select cast(o_orderkey as varchar) as order_nr, cast(o_custkey as varchar) as customer_number, o_orderdate as ordered_at, md5(cast(o_orderkey as varchar)) as hash_key from orders"


def suffix(salt):
    return f"lpad(cast({pick(salt, 10000, 'order_nr')} as varchar), 4, '0')"


@query(
    "mutate_orders",
    f"""with source as ({ORDER_ROWS}), month_rows as (
        select * from source where year(ordered_at) = 1997 and month(ordered_at) = 3)
    select order_nr, customer_number || {suffix('customer')} as customer_number, cast(ordered_at as date) as ordered_at, hash_key
    from month_rows
    union all
    select order_nr || {suffix('order')}, customer_number || {suffix('customer')}, cast(ordered_at + interval 365 day as date),
        md5(hash_key || order_nr || {suffix('hash')}) from month_rows""",
)
def mutate_orders(spark, d):
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_nr"), F.col("o_custkey").alias("customer_number"),
        F.col("o_orderdate").alias("ordered_at"), F.md5(F.col("o_orderkey").cast("string")).alias("hash_key"),
    )
    return sales.mutate_orders(orders, "update_insert", 1997, 3)
