"""Types, cleaning, validation, nesting and file round trips."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.session import fresh_dir
from tidemark.operators import cleaning, nested, report, validation
from tidemark.plans.registry import query
from tidemark.plans.tables import Tables, raw_sales, store_products, user_records
from tidemark.sources import readers, sinks

_RAW = """
    SELECT concat_ws('-', l_orderkey, l_linenumber) AS order_id,
           CASE WHEN l_linestatus = 'F' AND l_tax = 0.08 THEN 'n/a'
                ELSE strftime(l_shipdate, '%Y-%m-%d') END AS order_date,
           CASE WHEN l_discount = 0.06 THEN '' ELSE l_returnflag END AS region,
           l_linestatus AS category,
           cast(cast(CASE WHEN l_tax = 0.07 AND l_discount = 0.1 THEN l_quantity * 40
                          ELSE l_quantity END AS integer) AS varchar) AS quantity,
           CASE WHEN l_discount = 0.04 THEN ''
                WHEN l_tax = 0.03 AND l_discount = 0.02
                THEN cast(-l_extendedprice AS varchar) ELSE cast(l_extendedprice AS varchar) END AS unit_price,
           cast(l_discount AS varchar) AS discount
    FROM lineitem"""
_TYPED = f"""
    SELECT nullif(trim(order_id), '') AS order_id, try_cast(order_date AS date) AS order_date,
           nullif(trim(region), '') AS region, nullif(trim(category), '') AS category,
           try_cast(quantity AS integer) AS quantity, try_cast(unit_price AS double) AS unit_price,
           try_cast(discount AS double) AS discount
    FROM ({_RAW})"""
_FIXED = f"""
    SELECT * REPLACE (CASE WHEN unit_price >= 0 THEN unit_price END AS unit_price) FROM ({_TYPED})"""
_IMPUTED = f"""
    SELECT * REPLACE (coalesce(unit_price, (SELECT median(unit_price) FROM fixed)) AS unit_price,
                      coalesce(region, 'Unknown') AS region)
    FROM fixed"""
_CLIPPED = """
    SELECT * REPLACE (cast(greatest(
               (SELECT round(q1 - 1.5 * (q3 - q1)) FROM bounds),
               least((SELECT round(q3 + 1.5 * (q3 - q1)) FROM bounds), quantity)) AS integer) AS quantity)
    FROM {source}"""
_BOUNDS = "SELECT quantile_cont(quantity, 0.25) AS q1, quantile_cont(quantity, 0.75) AS q3 FROM {source}"
_FILLED = ("order_id", "region", "category", "quantity", "unit_price", "discount")
_MISSING = f"cast({len(_FILLED)} * count(*) - " + " - ".join(f"count({c})" for c in _FILLED) + " AS bigint)"


def _typed(t: Tables) -> DataFrame:
    return cleaning.normalise_types(raw_sales(t), readers.SALES)


@query("normalise_types", _TYPED)
def normalise_types(t: Tables) -> DataFrame:
    return _typed(t)


@query("null_profile", f"""
    WITH typed AS ({_TYPED}) """ + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing FROM typed""" for c in readers.SALES)
    + f" UNION ALL SELECT NULL, {' + '.join(f'count(*) - count({c})' for c in readers.SALES)} FROM typed")
def null_profile(t: Tables) -> DataFrame:
    return cleaning.null_profile(_typed(t))


@query("fix_negative", _FIXED)
def fix_negative(t: Tables) -> DataFrame:
    return cleaning.fix_negative(_typed(t), "unit_price")


@query("impute", f"WITH fixed AS ({_FIXED}) {_IMPUTED}")
def impute(t: Tables) -> DataFrame:
    return cleaning.impute(cleaning.fix_negative(_typed(t), "unit_price"), ["unit_price"], ["region"])


@query("clip_iqr", f"""
    WITH typed AS ({_TYPED}), bounds AS ({_BOUNDS.format(source="typed")})
    {_CLIPPED.format(source="typed")}""")
def clip_iqr(t: Tables) -> DataFrame:
    return cleaning.clip_iqr(_typed(t), "quantity")


@query("set_where", f"""
    SELECT * REPLACE (CASE WHEN quantity > 1000 THEN 0.5 ELSE discount END AS discount) FROM ({_TYPED})""")
def set_where(t: Tables) -> DataFrame:
    return cleaning.set_where(_typed(t), F.col("quantity") > 1000, "discount", 0.5)


@query("clean_report", f"""
    WITH typed AS ({_TYPED}), fixed AS ({_FIXED}), imputed AS ({_IMPUTED}),
         bounds AS ({_BOUNDS.format(source="imputed")}), clean AS ({_CLIPPED.format(source="imputed")})
    SELECT 'before' AS stage, count(*) AS n_rows, {_MISSING} AS missing, max(quantity) AS largest FROM typed
    UNION ALL SELECT 'after', count(*), {_MISSING}, max(quantity) FROM clean""")
def clean_report(t: Tables) -> DataFrame:
    raw = _typed(t)
    fixed = cleaning.fix_negative(raw, "unit_price")
    clean = cleaning.clip_iqr(cleaning.impute(fixed, ["unit_price"], ["region"]), "quantity")
    return cleaning.clean_report(raw, clean, _FILLED, "quantity")


@query("clean_sales_report", f"""
    WITH typed AS ({_TYPED}), fixed AS ({_FIXED}), imputed AS ({_IMPUTED}),
         bounds AS ({_BOUNDS.format(source="imputed")}), clean AS ({_CLIPPED.format(source="imputed")}),
         totals AS (SELECT category AS g, count(*) AS orders, sum(cast(unit_price AS decimal(12,2))) AS price_sum,
                           sum(quantity * cast(unit_price AS decimal(12,2)) * (1 - cast(discount AS decimal(4,2)))) AS total
                    FROM clean GROUP BY 1)
    SELECT row_number() OVER (ORDER BY total DESC, g) AS rank, g AS "group", orders AS "count",
           cast(price_sum AS double) / orders AS avg_price, cast(total AS double) AS total,
           round(cast(total AS double) / cast(max(total) OVER () AS double) * 100, 1) AS share_pct
    FROM totals""")
def clean_sales_report(t: Tables) -> DataFrame:
    """A raw feed typed, repaired, imputed and clipped, and then reported."""
    fixed = cleaning.fix_negative(_typed(t), "unit_price")
    clean = cleaning.clip_iqr(cleaning.impute(fixed, ["unit_price"], ["region"]), "quantity")
    return report.sales_report(report.fold_sales(clean, "category"), "category")


_PRODUCTS = """
    SELECT cast(p_partkey AS varchar) AS product_id,
           CASE WHEN p_brand = 'Brand#7' THEN ' ' ELSE p_name END AS product_name,
           p_type AS category,
           CASE WHEN p_brand = 'Brand#9' AND p_size > 25 THEN 0.0::double ELSE p_retailprice END AS price,
           cast(p_size AS bigint) - 2 AS stock,
           cast(floor(p_retailprice / 10) - 90 AS double) AS daily_sales,
           length(p_name) AS reorder_level,
           CASE WHEN p_type = 'PROMO' THEN 1 WHEN p_type = 'SMALL' THEN 2 ELSE 90 END AS expiry_days,
           CASE WHEN p_type = 'ECONOMY' THEN 700.0::double ELSE p_retailprice END AS last_price
    FROM part"""
VALID = f"SELECT * FROM ({_PRODUCTS}) WHERE length(trim(product_name)) >= 1 AND price > 0 AND stock >= 0"
# The messages and the advice.
INVALID = f"""
    WITH products AS ({_PRODUCTS}), failed AS (
        SELECT *, 'product_name' AS error_field, 'String should have at least 1 character' AS error_message,
               '바코드와 입고표를 확인해 상품명을 입력' AS recommended_action
        FROM products WHERE length(trim(product_name)) = 0
        UNION ALL SELECT *, 'price', 'Input should be greater than 0',
               '원가표를 확인하고 0원보다 큰 판매가를 다시 입력' FROM products WHERE NOT price > 0
        UNION ALL SELECT *, 'stock', 'Input should be greater than or equal to 0',
               '매대와 창고의 실재고를 다시 세어 0 이상으로 수정' FROM products WHERE NOT stock >= 0)
    SELECT product_id, coalesce(nullif(trim(product_name), ''), '상품명 누락') AS product_name,
           error_field, error_message, recommended_action
    FROM failed"""


@query("validate_valid", VALID)
def validate_valid(t: Tables) -> DataFrame:
    return validation.validate_products(store_products(t.part))[0]


@query("validate_invalid", INVALID)
def validate_invalid(t: Tables) -> DataFrame:
    return validation.validate_products(store_products(t.part))[1]


_USERS = """
    SELECT c_custkey AS id, c_nationkey * 3 - 2 AS age, c_acctbal / 95 AS score,
           CASE WHEN c_acctbal BETWEEN 0 AND 200 THEN 'at sign missing'
                WHEN c_acctbal BETWEEN 5000 AND 5200 THEN NULL
                ELSE lower(replace(c_name, '#', '_')) || '@example.com' END AS email
    FROM customer"""


@query("validate_users", f"""
    WITH users AS ({_USERS})
    SELECT id, 'age' AS error_field, 'Input should be greater than or equal to 0' AS error_message
    FROM users WHERE age < 0
    UNION ALL SELECT id, 'email', 'Field required' FROM users WHERE email IS NULL
    UNION ALL SELECT id, 'email', 'value is not a valid email address' FROM users WHERE email NOT LIKE '%@%.%'
    UNION ALL SELECT id, 'profile.score', 'Input should be greater than or equal to 0' FROM users WHERE score < 0
    UNION ALL SELECT id, 'profile.score', 'Input should be less than or equal to 100' FROM users WHERE score > 100""")
def validate_users(t: Tables) -> DataFrame:
    failed = validation.validate(user_records(t.customer), validation.user_rules())[1]
    return failed.select("id", "error_field", "error_message")


@query("split_counts", f"""
    WITH products AS ({_PRODUCTS})
    SELECT count(*) AS n_rows,
           count(*) FILTER (length(trim(product_name)) >= 1 AND price > 0 AND stock >= 0) AS valid,
           count(*) FILTER (NOT (length(trim(product_name)) >= 1 AND price > 0 AND stock >= 0)) AS invalid
    FROM products""")
def split_counts(t: Tables) -> DataFrame:
    """Valid and invalid rows together cover the input, each once."""
    products = store_products(t.part)
    valid, invalid = validation.validate(products, validation.product_rules())
    return (
        valid.select("product_id", F.lit("valid").alias("side"))
        .unionByName(invalid.select("product_id", F.lit("invalid").alias("side")).distinct())
        .agg(
            F.count("*").alias("n_rows"), F.count_if(F.col("side") == "valid").alias("valid"),
            F.count_if(F.col("side") == "invalid").alias("invalid"))
    )


@query("flatten_props", """
    SELECT event_id, event_type, cast(json_extract(props, '$.k') AS integer) AS k FROM events""")
def flatten_props(t: Tables) -> DataFrame:
    return nested.flatten_props(t.events.select("event_id", "event_type", "props"), "props", "k INT")


@query("flatten_products", """
    SELECT p_partkey AS id, p_name AS name, p_type AS category, p_retailprice AS price,
           p_size AS quantity, replace(p_name, ' ', '|') AS tags, s_suppkey AS seller_id, n_name AS seller_region
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
    GROUP BY ALL""")
def flatten_products(t: Tables) -> DataFrame:
    sellers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.struct(F.col("s_suppkey").alias("id"), F.col("n_name").alias("region")).alias("seller"))
    offers = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    products = t.part.select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("quantity"), F.split("p_name", " ").alias("tags"))
    return nested.flatten_products(offers.join(products, "l_partkey").join(sellers, "l_suppkey"))


# The names of the feeds. The last one holds whatever the others do not.
_FEEDS = {"매대": ("PROMO", "SMALL"), "창고": ("LARGE", "MEDIUM")}
_LAST_FEED = "공급업체"


@query("union_sources", """
    SELECT product_id, category, stock,
           CASE WHEN category IN ('PROMO', 'SMALL') THEN '매대'
                WHEN category IN ('LARGE', 'MEDIUM') THEN '창고' ELSE '공급업체' END AS source,
           CASE WHEN category IN ('PROMO', 'SMALL') THEN expiry_days END AS expiry_days
    FROM (""" + _PRODUCTS + ")")
def union_sources(t: Tables) -> DataFrame:
    """Three feeds, of which only the shelf feed knows the expiry date."""
    products = store_products(t.part).select("product_id", "category", "stock", "expiry_days")
    feeds = {name: products.where(F.col("category").isin(*types)) for name, types in _FEEDS.items()}
    listed = F.col("category").isin(*[c for types in _FEEDS.values() for c in types])
    feeds[_LAST_FEED] = products.where(~F.coalesce(listed, F.lit(False)))
    return readers.union_sources(
        {name: df if name == "매대" else df.drop("expiry_days") for name, df in feeds.items()})


@query("csv_round_trip", "SELECT * FROM part")
def csv_round_trip(t: Tables) -> DataFrame:
    """Written with a byte-order mark, read back with the schema."""
    path, part = fresh_dir(t.spark, "csv"), t.part
    sinks.write_csv(part, path)
    schema = ", ".join(f"{name} {kind}" for name, kind in part.dtypes)
    return readers.read_csv(t.spark, path, schema)


@query("parquet_round_trip", "SELECT * FROM part")
def parquet_round_trip(t: Tables) -> DataFrame:
    path, part = fresh_dir(t.spark, "parquet"), t.part
    sinks.write_parquet(part, path, ["p_type"])
    return t.spark.read.parquet(path).select(*part.columns)


@query("products_both_ways", f"""
    SELECT CAST(product_id AS bigint) AS product_id, product_name, price, stock, tags, 2 AS copies
    FROM (SELECT *, replace(product_name, ' ', '|') AS tags FROM ({VALID}))""")
def products_both_ways(t: Tables) -> DataFrame:
    """Valid products flattened, written as CSV and as Parquet, read back from both and matched."""
    valid = validation.validate_products(store_products(t.part))[0]
    flat = nested.flatten_products(valid.select(
        F.col("product_id").cast("bigint").alias("id"), F.col("product_name").alias("name"), "category", "price",
        F.col("stock").alias("quantity"), F.split("product_name", " ").alias("tags"),
        F.struct(F.lit(1).alias("id"), F.lit("shop").alias("region")).alias("seller")))
    csv, parquet = fresh_dir(t.spark, "csv"), fresh_dir(t.spark, "parquet")
    sinks.write_csv(flat, csv)
    sinks.write_parquet(flat, parquet, ["category"])
    schema = ", ".join(f"{name} {kind}" for name, kind in flat.dtypes)
    back = readers.read_csv(t.spark, csv, schema).unionByName(t.spark.read.parquet(parquet).select(*flat.columns))
    return back.groupBy(F.col("id").alias("product_id"), F.col("name").alias("product_name"), "price",
                        F.col("quantity").alias("stock"), "tags").agg(F.count("*").alias("copies"))


@query("api_scan", """
    SELECT c_custkey AS id, lower(replace(c_name, '#', '_')) AS username, c_mktsegment AS country,
           CASE WHEN c_nationkey > 12 THEN 2 ELSE 1 END AS tag_count
    FROM customer""")
def api_scan(t: Tables) -> DataFrame:
    """User records written as API pages of at most 100 records, one per line, and read back."""
    path, users = fresh_dir(t.spark, "api"), user_records(t.customer)
    pages = users.groupBy(F.floor(F.col("id") / 100).alias("page")).agg(
        F.lit("ok").alias("status"), F.count("*").alias("count"),
        F.collect_list(F.struct(*users.columns)).alias("results"))
    pages.drop("page").write.json(path)
    return readers.read_api(t.spark, path, multi_line=False).select(
        "id", "username", F.col("profile.country").alias("country"), F.size("tags").alias("tag_count"))
