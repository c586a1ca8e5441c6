"""Landed API documents, derived by Spark from the driver's flat tables.

The engine's real input is pages of nested JSON landed from the store API
(read with :mod:`ledgerline.sources.pages`). For tests and benchmarks the same
nested shapes are built here from the TPC-H-like tables, so that the flatten
jobs have real work that grows with the data, and an independent SQL over the
flat tables can check the round trip (nest -> flatten == plain SQL).

Derivation rules (shared with the oracle SQL in ``plans/oracle.py``):

* store of an order / customer: ``store-{c_nationkey % 5}.myshopify.com``
* order gid ``gid://shop/Order/{o_orderkey}``; line item gid over a composite
  digit key (orderkey, linenumber, partkey, suppkey, shipdate) since
  (orderkey, linenumber) is not unique
* money amounts are decimal strings with 4 places
* processedAt = orderdate + (orderkey % 24) hours, createdAt = orderdate,
  updatedAt = orderdate + 2 days (null when orderkey % 13 = 0)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.nesting import nest_split
from ..session import fresh_path, shuffles_go_with_writes
from ..sources.tables import read, slices_of

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
STORE_COUNT = 5
# Synthetic per-store settings, indexed by store number % 5 (fixture choices).
STORE_TIMEZONES = ["UTC", "America/New_York", "Europe/Paris", "Asia/Tokyo", None]
STORE_CURRENCIES = ["USD", "USD", "EUR", "JPY", "AUD"]


def m(x: Column) -> Column:
    """Money bag ``{shopMoney:{amount}}`` with a 4-place decimal string."""
    return F.struct(F.struct(x.cast("decimal(18,4)").cast("string").alias("amount")).alias("shopMoney"))


def iso(ts: Column) -> Column:
    return F.date_format(ts, ISO)


def store_of(nationkey: Column) -> Column:
    return F.concat(F.lit("store-"), (nationkey % STORE_COUNT).cast("string"), F.lit(".myshopify.com"))


def _pick(values: list, idx: Column) -> Column:
    e = F.lit(None).cast("string")
    for i, v in reversed(list(enumerate(values))):
        e = F.when(idx == i, F.lit(v)).otherwise(e)
    return e


def line_key(c=F.col) -> Column:
    return F.concat(c("l_orderkey").cast("string"),
                    F.lpad(c("l_linenumber").cast("string"), 4, "0"),
                    F.lpad(c("l_partkey").cast("string"), 10, "0"),
                    F.lpad(c("l_suppkey").cast("string"), 10, "0"),
                    F.date_format(c("l_shipdate"), "yyyyMMdd"))


def _orders_with_store(spark, sf_dir) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey, "left").withColumn("store_name", store_of(F.col("c_nationkey")))


# ---------------------------------------------------------------------------
# Orders with line items, refunds and shipping lines (SRC2 shape)
# ---------------------------------------------------------------------------
def _item_node(c=F.col) -> Column:
    price = c("l_extendedprice")
    brand_no = F.regexp_extract(c("p_brand"), "([0-9]+)$", 1)
    allocs = F.when(c("l_discount") == 0, F.array()).otherwise(
        F.concat(F.array(F.struct(m(price * c("l_discount")).alias("allocatedAmountSet"))),
                 F.when(c("l_linestatus") == "O",
                        F.array(F.struct(m(c("l_quantity")).alias("allocatedAmountSet"))))
                 .otherwise(F.array())))
    tax = F.when(c("l_tax") == 0, F.array()).otherwise(
        F.concat(F.array(F.struct(m(price * c("l_tax")).alias("priceSet"), c("l_tax").alias("rate"))),
                 F.when(c("l_returnflag") == "A",
                        F.array(F.struct(m(c("l_quantity")).alias("priceSet"), F.lit(0.01).alias("rate"))))
                 .otherwise(F.array())))
    return F.struct(
        F.concat(F.lit("gid://shop/LineItem/"), line_key(c)).alias("id"),
        F.when(c("l_returnflag") == "R", F.lit(0)).otherwise(c("l_quantity").cast("bigint")).alias("currentQuantity"),
        c("l_quantity").cast("bigint").alias("quantity"),
        c("p_name").alias("title"),
        F.when(c("l_partkey") % 13 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("SKU-"), c("l_partkey").cast("string"))).alias("sku"),
        c("p_brand").alias("vendor"),
        F.when(c("l_partkey") % 11 == 0, F.lit(None)).otherwise(
            F.struct(F.concat(F.lit("gid://shop/Product/"), brand_no).alias("id"))).alias("product"),
        F.struct(F.concat(F.lit("gid://shop/ProductVariant/"), c("l_partkey").cast("string")).alias("id")).alias("variant"),
        m(price).alias("originalTotalSet"),
        m(price * (1 - c("l_discount"))).alias("discountedTotalSet"),
        m(c("p_retailprice")).alias("originalUnitPriceSet"),
        m(c("p_retailprice") * (1 - c("l_discount"))).alias("discountedUnitPriceSet"),
        allocs.alias("discountAllocations"),
        tax.alias("taxLines"),
        c("p_type").alias("variantTitle"),
    )


def _refund_item(restock: Column, subtotal: Column, c=F.col) -> Column:
    return F.struct(F.struct(restock.alias("restockType"), m(subtotal).alias("subtotalSet"),
                             F.struct(F.concat(F.lit("gid://shop/LineItem/"), line_key(c)).alias("id")).alias("lineItem"))
                    .alias("node"))


def processed_at(c=F.col) -> Column:
    return F.when(c("o_orderkey") % 101 == 50, F.lit(None)).otherwise(
        iso(c("o_orderdate") + F.make_interval(hours=(c("o_orderkey") % 24).cast("int"))))


def _order_header(c=F.col) -> list[Column]:
    k = c("o_orderkey")
    ts = c("o_orderdate")
    pri = c("o_orderpriority")
    return [
        iso(ts).alias("createdAt"),
        processed_at(c).alias("processedAt"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(iso(ts + F.expr("INTERVAL 2 DAYS"))).alias("updatedAt"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(
            F.concat(F.lower(F.replace(c("c_name"), F.lit("#"), F.lit(""))), F.lit("@example.com"))).alias("email"),
        F.when(c("o_orderstatus") == "F", "PAID").when(c("o_orderstatus") == "O", "PENDING")
        .otherwise("PARTIALLY_REFUNDED").alias("displayFinancialStatus"),
        F.concat(F.lit("#"), (k + 1000).cast("string")).alias("name"),
        F.when(pri == "1-URGENT", F.array(F.lit("card_payments"), F.lit("gift_card")))
        .when(pri == "2-HIGH", F.array(F.lit("card_payments")))
        .when(pri == "3-MEDIUM", F.array(F.lit("manual")))
        .when(pri == "4-NOT SPECIFIED", F.array().cast("array<string>"))
        .otherwise(F.lit(None).cast("array<string>")).alias("paymentGatewayNames"),
        _pick(STORE_CURRENCIES, c("c_nationkey") % STORE_COUNT).alias("currencyCode"),
        m(c("o_totalprice") * 0.05).alias("totalDiscountsSet"),
        m(c("o_totalprice")).alias("totalPriceSet"),
    ]


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "c_name", "c_nationkey"]
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus", "p_name", "p_brand", "p_type", "p_retailprice"]


def order_items_plain(spark: SparkSession, sf_dir: str, part: tuple[int, int] | None = None) -> DataFrame:
    """One row per (order, document part) in plain columns: the order's own and
    ``items``, an array of its lines in any order; :func:`order_item_node` nests them.
    With ``part`` (number, of how many) those orders alone whose key hashes to it."""
    some = lambda df, key: df if part is None else df.where(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(part[1])) == part[0])
    li = some(read(spark, sf_dir, "lineitem"), "l_orderkey")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    items = li.join(p, li.l_partkey == p.p_partkey, "left").select(*LINE_COLUMNS)
    grouped = nest_split(items, ["l_orderkey"], F.struct(*LINE_COLUMNS), line_key(), ordered=False,
                         count_source=some(read(spark, sf_dir, "lineitem", spread=False), "l_orderkey"))   # map-side combined count: no spread needed
    o = some(_orders_with_store(spark, sf_dir), "o_orderkey").select("store_name", *ORDER_COLUMNS)
    return o.join(grouped, o.o_orderkey == grouped.l_orderkey, "left") \
        .withColumn("order_key", F.col("o_orderkey")).withColumn("doc_part", F.coalesce("doc_part", F.lit(0))) \
        .withColumn("items", F.coalesce("items", F.array().cast(grouped.schema["items"].dataType))).drop("l_orderkey")


#: Bytes of lineitem whose shuffles are on disk at once in :func:`order_items_kept`, and the most slices that it is read in.
SLICE_BYTES = 512 << 20
MOST_SLICES = 16


def order_items_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of :func:`order_items_plain`, written once (zstd Parquet) by slices
    of the order key, and read back: for a query that reads them more than once or
    moves them again. On disk are the rows, and the shuffles of one slice at a time."""
    n, path = slices_of(spark, sf_dir, "lineitem", SLICE_BYTES, MOST_SLICES), fresh_path(spark, "order-items")
    with shuffles_go_with_writes(spark):
        for k in range(n):
            rows = order_items_plain(spark, sf_dir, (k, n) if n > 1 else None)
            rows.write.option("compression", "zstd").parquet(f"{path}/slice-{k}")
    return spark.read.schema(rows.schema).parquet(*[f"{path}/slice-{k}" for k in range(n)])


def order_item_node(c=F.col) -> list[Column]:
    """Fields of an order node (SRC2 shape) from the columns of :func:`order_items_plain`, of which ``c`` gives one by name."""
    k = c("o_orderkey")
    ordered = lambda arr, value: F.transform(F.array_sort(F.transform(arr, lambda x: F.struct(
        line_key(x.getField).alias("k"), value(x.getField).alias("v")))), lambda x: x["v"])
    is_r = lambda x: F.coalesce(x["l_returnflag"] == "R", F.lit(False))
    refund_a = lambda l: _refund_item(F.when(l("l_linestatus") == "O", F.lit("RETURN")), l("l_extendedprice") * (1 - l("l_discount")), l)
    refund_b = lambda l: _refund_item(F.lit("NO_RESTOCK"), l("l_extendedprice") * l("l_tax"), l)
    ra = ordered(F.filter(c("items"), is_r), refund_a)
    rb = ordered(F.filter(c("items"), lambda x: is_r(x) & F.coalesce(x["l_linestatus"] == "F", F.lit(False))), refund_b)
    refund = lambda kind, arr: F.struct(
        F.concat(F.lit(f"gid://shop/Refund/{kind}"), k.cast("string"), F.lit("-"), c("doc_part").cast("string")).alias("id"),
        F.struct(arr.alias("edges")).alias("refundLineItems"))
    return [
        *_order_header(c),
        F.when(c("o_orderpriority") == "1-URGENT", "URGENT10").when(c("o_orderpriority") == "2-HIGH", "HIGH5").alias("discountCode"),
        F.struct(F.when(k % 7 == 0, F.array()).otherwise(F.array(F.struct(F.struct(
            F.when(c("o_orderstatus") == "O", "STANDARD").otherwise("EXPRESS").alias("code"),
            m(c("o_totalprice") * 0.01).alias("discountedPriceSet")).alias("node")))).alias("edges")).alias("shippingLines"),
        F.filter(F.array(refund("A", ra), refund("B", rb)), lambda r: F.size(r["refundLineItems"]["edges"]) > 0).alias("refunds"),
        F.struct(F.transform(ordered(c("items"), _item_node), lambda x: F.struct(x.alias("node"))).alias("edges")).alias("lineItems")]


def order_item_docs(spark: SparkSession, sf_dir: str, kept: bool = False) -> DataFrame:
    """One row per (order, document part): the order node with nested lineItems,
    refunds and shippingLines, plus ``store_name`` (added at landing). ``kept``:
    made from rows that are written first (:func:`order_items_kept`)."""
    plain = order_items_kept if kept else order_items_plain
    return plain(spark, sf_dir).select("store_name", "order_key", "doc_part", *order_item_node())


# ---------------------------------------------------------------------------
# Order documents (SRC1 shape): first 10 line items only, as the API returns
# ---------------------------------------------------------------------------
ORDER_NAME_CAP = 10


def order_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order in plain columns, without its lines."""
    o = _orders_with_store(spark, sf_dir)
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    o = o.join(F.broadcast(n), o.c_nationkey == n.n_nationkey, "left")  # nation: 25 rows by TPC-H definition
    return o.select("store_name", F.col("o_orderkey").alias("order_key"), *ORDER_COLUMNS, "n_name")


def orders_plain(spark: SparkSession, sf_dir: str, heads: DataFrame | None = None) -> DataFrame:
    """Orders (``heads``, default: all of :func:`order_heads`) with ``names``, the
    names and vendors of their first lines; :func:`order_node` nests them."""
    from pyspark.sql.window import Window
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    sk = line_key()
    # top-10 per order: row_number <= k is planned with a map-side WindowGroupLimit,
    # so a hot order ships at most 10 rows per map task to the final window.
    w = Window.partitionBy("l_orderkey").orderBy(sk)
    first10 = li.withColumn("_sk", sk).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= ORDER_NAME_CAP)
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    named = first10.join(p, first10.l_partkey == p.p_partkey, "left")
    grouped = named.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_sk").alias("k"), F.struct(
            F.col("p_name").alias("name"), F.col("p_brand").alias("vendor")).alias("v")))).alias("_s")) \
        .select("l_orderkey", F.transform("_s", lambda x: x["v"]).alias("names"))
    o = order_heads(spark, sf_dir) if heads is None else heads
    return o.join(grouped, o.o_orderkey == grouped.l_orderkey, "left").drop("l_orderkey")


def order_node(c=F.col) -> list[Column]:
    """Fields of an order node (SRC1 shape) from the columns of :func:`orders_plain`, of which ``c`` gives one by name."""
    k = c("o_orderkey")
    tp = c("o_totalprice")
    st = c("o_orderstatus")
    pri = c("o_orderpriority")
    money_struct = lambda x: F.struct(F.struct(x.cast("decimal(18,4)").cast("string").alias("amount")).alias("shopMoney"))
    return [
        *_order_header(c),
        F.when(pri == "1-URGENT", F.array(F.lit("URGENT10"))).when(pri == "2-HIGH", F.array(F.lit("HIGH5"), F.lit("VIP")))
        .when(pri == "5-LOW", F.lit(None).cast("array<string>")).otherwise(F.array().cast("array<string>")).alias("discountCodes"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.struct(
            F.when(st == "O", "Standard").otherwise("Express").alias("title"),
            (tp * 0.01).cast("decimal(18,4)").cast("string").alias("price"),
            F.when(k % 3 == 0, F.array()).otherwise(F.array(F.struct(
                F.lit(0.05).alias("rate"), money_struct(tp * 0.02).alias("priceSet")))).alias("taxLines"))).alias("shippingLine"),
        F.when((st == "P") & (k % 5 == 0), iso(c("o_orderdate") + F.expr("INTERVAL 3 DAYS"))).alias("cancelledAt"),
        F.concat(F.lit("C"), k.cast("string")).alias("confirmationNumber"),
        F.when(st == "F", "FULFILLED").when(st == "O", "UNFULFILLED").otherwise("PARTIALLY_FULFILLED").alias("displayFulfillmentStatus"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("/products/p"), (k % 50).cast("string"))).alias("landingPageUrl"),
        F.when(k % 9 == 0, F.lit("gift wrap")).alias("note"),
        F.when(st == "P", F.array(F.concat(F.lit("status-"), st), pri, F.lit("réduit")))
        .otherwise(F.array(F.concat(F.lit("status-"), st), pri)).alias("tags"),
        F.when(st == "F", m(tp * 0.1)).alias("totalRefundedSet"),
        F.when(k % 6 == 0, m(tp * 0.02)).alias("currentTotalDutiesSet"),
        F.when(k % 8 == 0, m(F.lit(1.5))).alias("currentTotalAdditionalFeesSet"),
        F.concat(F.array(F.struct(m(tp * 0.05).alias("priceSet"), F.lit(0.05).alias("rate"))),
                 F.when(st == "F", F.array(F.struct(m(tp * 0.01).alias("priceSet"), F.lit(0.01).alias("rate"))))
                 .otherwise(F.array())).alias("taxLines"),
        F.when(k % 10 == 0, F.lit(None)).otherwise(
            F.struct((tp * 0.01).cast("decimal(18,4)").cast("string").alias("amount"))).alias("totalTipReceived"),
        F.when(c("o_custkey") % 19 == 0, F.lit(None)).otherwise(F.struct(
            F.concat(F.lit("gid://shop/Customer/"), c("o_custkey").cast("string")).alias("id"),
            F.struct(c("n_name").alias("country")).alias("defaultAddress"))).alias("customer"),
        F.struct(F.transform(F.coalesce(c("names"), F.array().cast("array<struct<name:string,vendor:string>>")),
                             lambda x: F.struct(x.alias("node"))).alias("edges")).alias("lineItems")]


def order_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_plain(spark, sf_dir).select("store_name", "order_key", *order_node())


# ---------------------------------------------------------------------------
# Customer documents (SRC3 shape)
# ---------------------------------------------------------------------------
def customer_docs(spark: SparkSession, sf_dir: str, include_pii: bool = True) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    # per-customer aggregates are partial (map-side) aggregates: hot customers are cheap
    agg = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,4)")).alias("spent"),
        F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("last_key"))
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    ck = F.col("c_custkey")
    base = (c.join(agg, c.c_custkey == agg.o_custkey, "left")
            .join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left"))  # nation: fixed 25 rows
    created = F.to_timestamp(F.lit("2015-01-01")) + F.make_interval(days=(ck % 2000).cast("int"))
    cols = [
        "store_name" if False else store_of(F.col("c_nationkey")).alias("store_name"),
        F.concat(F.lit("gid://shop/Customer/"), ck.cast("string")).alias("id"),
        F.when(F.col("last_key").isNull(), F.lit(None)).otherwise(F.struct(
            F.concat(F.lit("gid://shop/Order/"), F.col("last_key").cast("string")).alias("id"),
            F.concat(F.lit("#"), (F.col("last_key") + 1000).cast("string")).alias("name"))).alias("lastOrder"),
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("string").alias("numberOfOrders"),
        F.struct(F.coalesce(F.col("spent"), F.lit(0).cast("decimal(18,4)")).cast("decimal(18,4)").cast("string").alias("amount"),
                 _pick(STORE_CURRENCIES, F.col("c_nationkey") % STORE_COUNT).alias("currencyCode")).alias("amountSpent"),
        F.when(ck % 23 == 0, F.lit("not-a-date")).otherwise(iso(created)).alias("createdAt"),
        iso(created + F.expr("INTERVAL 1 DAY")).alias("updatedAt"),
    ]
    if include_pii:
        cols += [
            F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(""))), F.lit("@example.com")).alias("email"),
            F.concat(F.lit("First"), ck.cast("string")).alias("firstName"),
            F.col("c_name").alias("displayName"),
            F.when(ck % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("+1-555-"), F.lpad(ck.cast("string"), 4, "0"))).alias("phone"),
            F.when(ck % 4 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("note"),
            F.when(ck % 5 == 0, F.lit(None).cast("array<string>")).when(ck % 5 == 1, F.array().cast("array<string>"))
            .otherwise(F.array(F.col("c_mktsegment"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")))).alias("tags"),
            F.when(ck % 7 == 0, F.lit(None)).otherwise(F.struct(
                F.concat(F.lit("gid://shop/MailingAddress/"), ck.cast("string")).alias("id"),
                F.concat(F.lit("First"), ck.cast("string")).alias("firstName"),
                F.concat(F.lit("Last"), ck.cast("string")).alias("lastName"),
                F.when(ck % 2 == 0, F.col("c_mktsegment")).alias("company"),
                F.concat((ck % 997).cast("string"), F.lit(" Main St")).alias("address1"),
                F.lit(None).cast("string").alias("address2"),
                F.concat(F.lit("City"), (ck % 50).cast("string")).alias("city"),
                F.concat(F.lit("Province"), (ck % 10).cast("string")).alias("province"),
                F.col("n_name").alias("country"),
                F.lpad((ck % 100000).cast("string"), 5, "0").alias("zip"),
                F.lit(None).cast("string").alias("phone"),
                F.col("c_name").alias("name"))).alias("defaultAddress"),
        ]
    return base.select(*cols)


# ---------------------------------------------------------------------------
# Product documents (SRC4 shape): one product per (brand), parts as variants
# ---------------------------------------------------------------------------
def product_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    brand_no = F.regexp_extract(F.col("p_brand"), "([0-9]+)$", 1).cast("int")
    variant = F.when(pk % 29 == 0, F.lit(None)).otherwise(F.struct(
        F.concat(F.lit("gid://shop/ProductVariant/"), pk.cast("string")).alias("id"),
        F.concat(F.lit("SKU-"), pk.cast("string")).alias("sku"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").cast("decimal(18,2)").cast("string").alias("price"),
        F.when(pk % 3 == 0, F.lit(None)).otherwise(
            (F.col("p_retailprice") * 2).cast("decimal(18,2)").cast("string")).alias("compareAtPrice"),
        iso(F.to_timestamp(F.lit("2020-01-01")) + F.make_interval(days=(pk % 1000).cast("int"))).alias("createdAt"),
        F.when(pk % 5 == 0, F.lit(None)).otherwise(F.struct(
            F.concat(F.lit("gid://shop/InventoryItem/"), pk.cast("string")).alias("id"))).alias("inventoryItem"),
        F.when(pk % 17 == 0, F.lit(None)).otherwise(F.col("p_size").cast("bigint")).alias("inventoryQuantity"),
        F.when(pk % 2 == 0, F.struct(F.concat(F.lit("https://cdn.example.com/v/"), pk.cast("string"), F.lit(".png")).alias("url")))
        .alias("image")))
    parts = p.withColumn("brand_no", brand_no)
    grouped = nest_split(parts, ["brand_no", "p_brand"], variant, F.lpad(pk.cast("string"), 12, "0"), name="variants",
                         count_source=read(spark, sf_dir, "part", spread=False).withColumn("brand_no", brand_no))
    # product documents of more than 250 variants are split into parts; each part repeats the product
    b = F.col("brand_no")
    created = F.to_timestamp(F.lit("2019-01-01")) + F.make_interval(days=b.cast("int"))
    media = F.when(b % 4 == 0, F.array()).otherwise(F.array(F.struct(
        F.lit("IMAGE").alias("mediaContentType"),
        F.struct(F.concat(F.lit("https://cdn.example.com/p/"), b.cast("string"), F.lit(".jpg")).alias("url"),
                 F.lit(None).cast("string").alias("altText")).alias("image"))))
    node = F.struct(
        iso(created).alias("createdAt"),
        iso(created + F.expr("INTERVAL 30 DAYS")).alias("updatedAt"),
        F.concat(F.lit("gid://shop/Product/"), b.cast("string")).alias("id"),
        F.col("p_brand").alias("title"),
        F.when(b % 2 == 0, "Hardware").otherwise("Apparel").alias("productType"),
        F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit("-"))).alias("handle"),
        F.when(b % 7 == 0, "DRAFT").otherwise("ACTIVE").alias("status"),
        F.when(b % 7 == 0, F.lit(None)).otherwise(iso(created + F.expr("INTERVAL 1 DAY"))).alias("publishedAt"),
        F.when(b % 3 == 0, F.array().cast("array<string>")).otherwise(
            F.array(F.lit("brand"), F.concat(F.lit("b"), b.cast("string")))).alias("tags"),
        F.concat(F.lit("Vendor "), b.cast("string")).alias("vendor"),
        F.struct(media.alias("nodes")).alias("media"),
        F.struct(F.transform("variants", lambda v: F.struct(v.alias("node"))).alias("edges")).alias("variants"))
    return grouped.select(
        F.concat(F.lit("store-"), (b % STORE_COUNT).cast("string"), F.lit(".myshopify.com")).alias("store_name"),
        b.alias("product_key"), "doc_part",
        F.when(b == 13, F.lit(None)).otherwise(node).alias("node"))
