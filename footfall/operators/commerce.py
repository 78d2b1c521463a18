"""Orders, their lines, and legacy transactions."""

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions import money, money_text
from footfall.operators.bodies import BODY, parse_order
from footfall.operators.legacy import custom_dimension, decode_custom_vars

_KEPT = ("projectId", "siteId", "deviceId", "eventTime", "sn")


def order_table(events: DataFrame) -> DataFrame:
    """One row per order event with its totals and the raw arrays."""
    orders = parse_order(events)
    names = [c for c in orders.columns if c != "orderInfo"]
    return orders.select(*names, "orderInfo.*")


def order_products(orders: DataFrame) -> DataFrame:
    """One row per product of an order; an order without products gives one row
    of NULLs. The "no price" sentinel -1 becomes NULL."""
    rows = orders.select(
        *[c for c in (*_KEPT, "orderID") if c in orders.columns],
        F.posexplode_outer("productInfo").alias("line", "__product"),
    )
    rows = rows.select(*[c for c in rows.columns if c != "__product"], "__product.*")
    return rows.withColumn(
        "productOriPrice", F.when(F.col("productOriPrice") != -1, F.col("productOriPrice"))
    )


def order_coupons(orders: DataFrame) -> DataFrame:
    rows = orders.select(
        *[c for c in (*_KEPT, "orderID") if c in orders.columns],
        F.posexplode_outer("couponInfo").alias("line", "__coupon"),
    )
    return rows.select(*[c for c in rows.columns if c != "__coupon"], "__coupon.*")


def order_subtotal(total="orderAMT", shipping="shipAMT") -> Column:
    """Total without shipping; NULL unless both are known."""
    return money(money(total) - money(shipping))


def encode_legacy_items(products) -> Column:
    """JSON array of ["sku:<sku>", title, category, price, quantity], only of
    products with a sku and a title."""
    products = F.col(products) if isinstance(products, str) else products
    named = F.filter(products, lambda p: p["sku"].isNotNull() & p["productTitle"].isNotNull())

    def item(p):
        # a JSON array of mixed types: the quantity is a number, the rest is text
        quoted = F.to_json(
            F.array(
                F.concat(F.lit("sku:"), p["sku"]),
                p["productTitle"],
                F.coalesce(p["productCategory"], F.lit("")),
                money_text(p["productRealPrice"]),
            )
        )
        return F.concat(
            F.regexp_replace(quoted, r"\]$", ","), p["productQuantity"].cast("string"), F.lit("]")
        )

    return F.concat(F.lit("["), F.array_join(F.transform(named, item), ","), F.lit("]"))


def legacy_order_items(orders: DataFrame) -> DataFrame:
    """Legacy order columns; `ec_items` is NULL when no product qualifies, and
    then the order has no legacy item row."""
    items = encode_legacy_items("productInfo")
    return orders.withColumns(
        {
            "ec_items": F.when(items != "[]", items),
            "ec_id": F.col("orderID"),
            "revenue": money_text("orderAMT"),
            "ec_sh": money_text("shipAMT"),
            "ec_st": money_text(order_subtotal()),
        }
    )


def with_order_items(events: DataFrame) -> DataFrame:
    """The events, and after each order that has qualifying products its legacy item row: the
    same event without a body, with `ec_items`, `ec_id`, `revenue`, `ec_sh` and `ec_st`. These
    are NULL on all other rows. A body is only parsed on orders; nothing is read twice."""
    order = F.when(F.col("eventName") == "order", F.from_json("eventBody", BODY["order"]))
    rows = events.withColumn("__order", order)
    inner = {n: F.col(f"__order.orderInfo.{n}") for n in ("orderAMT", "shipAMT", "orderID")}
    items = encode_legacy_items("__order.productInfo")
    amounts = {
        "ec_items": F.when(items != "[]", items),
        "ec_id": inner["orderID"],
        "revenue": money_text(inner["orderAMT"]),
        "ec_sh": money_text(inner["shipAMT"]),
        "ec_st": money_text(order_subtotal(inner["orderAMT"], inner["shipAMT"])),
    }
    rows = rows.withColumns(amounts).drop("__order")
    both, one = F.array(F.lit(False), F.lit(True)), F.array(F.lit(False))
    rows = rows.withColumn("__item", F.explode(F.when(F.col("ec_items").isNotNull(), both).otherwise(one)))
    rows = rows.withColumns({c: F.when(F.col("__item"), F.col(c)) for c in amounts})
    return rows.withColumn("eventBody", F.when(~F.col("__item"), F.col("eventBody"))).drop("__item")


def decode_legacy_items(rows: DataFrame, items: str = "ec_items") -> DataFrame:
    """One row per item. Positions are only reliable when all five are present,
    because absent fields are skipped; other items keep `raw` and are marked."""
    parsed = F.from_json(items, "ARRAY<ARRAY<STRING>>")
    rows = rows.select(
        *[c for c in rows.columns if c != items], F.posexplode_outer(parsed).alias("line", "raw")
    )
    full = F.size("raw") == 5

    def part(i):
        return F.when(full, F.get(F.col("raw"), F.lit(i)))

    return rows.withColumns(
        {
            "sku": F.regexp_replace(part(0), "^sku:", ""),
            "title": part(1),
            "category": part(2),
            "price": F.replace(part(3), F.lit(","), F.lit("")).try_cast("decimal(18,2)"),
            "quantity": part(4).try_cast("bigint"),
            "ambiguous": F.col("raw").isNotNull() & ~full,
        }
    )


def parse_transaction(legacy: DataFrame, screen: str = "OrderCreation") -> DataFrame:
    """Legacy transactions as they reach the wire: a view of the order screen
    whose custom dimension holds the order id."""
    rows = legacy.where(F.element_at(F.split("action_name", "/"), -1) == screen)
    rows = decode_custom_vars(rows)
    rows = rows.withColumn("identifier", custom_dimension(F.col("customvariable"))["OrderId"])
    return rows.where(F.col("identifier").isNotNull())
