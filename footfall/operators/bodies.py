"""Typed event bodies.

Filter on the event name first, then parse: only the matching rows pay for JSON.
Money travels as two-decimal text and is read as DECIMAL(18,2).
"""

from functools import partial

from pyspark.sql import DataFrame, functions as F, types as T

from footfall.functions import json_object
from footfall.operators.filters import valid_custom_name
from footfall.schema import DEVICE, KNOWN_EVENTS

_UD = "udVariable MAP<STRING,STRING>"

ORDER_INFO = (
    "orderInfo STRUCT<orderID STRING, orderAMT DECIMAL(18,2), shipAMT DECIMAL(18,2), "
    "shipAddress STRING, shipMethod STRING>"
)
COUPONS = "couponInfo ARRAY<STRUCT<couponType STRING, couponAMT DECIMAL(18,2)>>"
PRODUCTS = (
    "productInfo ARRAY<STRUCT<sku STRING, productSourceSku STRING, productCategory STRING, "
    "productRealPrice DECIMAL(18,2), productOriPrice DECIMAL(18,2), productQuantity BIGINT, "
    "productTitle STRING>>"
)

# Fields of each event body.
BODY = {
    "pageview": _UD,
    "search": f"keyword STRING, recommendationSearchFlag INT, historySearchFlag INT, {_UD}",
    "productPage": (
        "sku STRING, productCategory1 STRING, productCategory2 STRING, productCategory3 STRING, "
        f"productOriginalPrice DECIMAL(18,2), productRealPrice DECIMAL(18,2), {_UD}"
    ),
    "addCart": f"sku STRING, productQuantity BIGINT, productRealPrice DECIMAL(18,2), {_UD}",
    "order": f"{ORDER_INFO}, {COUPONS}, {PRODUCTS}",
    "payment": (
        f"orderID STRING, payMethod STRING, payStatus INT, payAMT DECIMAL(18,2), {_UD}"
    ),
    "preCharge": (
        "chargeAMT DECIMAL(18,2), chargeMethod STRING, payStatus INT, "
        f"couponAMT DECIMAL(18,2), {_UD}"
    ),
    "register": f"uid STRING, type STRING, authenticated INT, registrationID STRING, {_UD}",
    "login": f"registrationID STRING, {_UD}",
    "logout": _UD,
    "click": "eType STRING, ePath STRING, ePosition STRING, eContent STRING, id STRING",
    "jPush": (
        "pushInfo MAP<STRING,STRING>, pushContent STRING, dcid INT, dtg INT, " + _UD
    ),
    "initJPush": f"pushManager MAP<STRING,STRING>, {_UD}",
    "openChannel": f"openChannelName STRING, {_UD}",
}

_FLAGS = {
    "recommendationSearchFlag", "historySearchFlag", "payStatus", "authenticated",
}
ENVELOPE = (*DEVICE, "userId", "eventTime", "sn", "url", "title")


def parse(events: DataFrame, name: str, keep=ENVELOPE) -> DataFrame:
    """Events of one kind with their body as columns; 0/1 flags as BOOLEAN."""
    body = F.from_json("eventBody", BODY[name])
    rows = events.where(F.col("eventName") == name).withColumn("__body", body)
    rows = rows.select(*[c for c in keep if c in events.columns], "__body.*")
    return rows.withColumns({c: F.col(c) == 1 for c in rows.columns if c in _FLAGS})


parse_pageview = partial(parse, name="pageview")
parse_search = partial(parse, name="search")
parse_product_page = partial(parse, name="productPage")
parse_add_cart = partial(parse, name="addCart")
parse_order = partial(parse, name="order")
parse_payment = partial(parse, name="payment")
parse_pre_charge = partial(parse, name="preCharge")
parse_register = partial(parse, name="register")
parse_login = partial(parse, name="login")
parse_logout = partial(parse, name="logout")
parse_click = partial(parse, name="click")
parse_init_push = partial(parse, name="initJPush")
parse_open_channel = partial(parse, name="openChannel")


def parse_push(events: DataFrame, keep=ENVELOPE) -> DataFrame:
    """Push events; missing content is empty text, missing ids are 0."""
    rows = parse(events, "jPush", keep)
    return rows.withColumns(
        {
            "alias": F.col("pushInfo")["alias"],
            "registrationID": F.col("pushInfo")["registrationID"],
            "tag": F.col("pushInfo")["tag"],
            "pushContent": F.coalesce("pushContent", F.lit("")),
            "dcid": F.coalesce("dcid", F.lit(0)),
            "dtg": F.coalesce("dtg", F.lit(0)),
        }
    )


def parse_custom(events: DataFrame, keep=ENVELOPE) -> DataFrame:
    """Events with a name of the caller's own; the body is the variables."""
    rows = events.where(~F.coalesce(F.col("eventName").isin(*KNOWN_EVENTS), F.lit(False)))
    return rows.select(
        *[c for c in keep if c in events.columns],
        "eventName",
        F.from_json("eventBody", "MAP<STRING,STRING>").alias("vars"),
    )


def parse_h5(messages: DataFrame, message: str = "message") -> DataFrame:
    """Messages of embedded web pages. `eventBody` may be an object or the text
    of one; either way it comes out as JSON text (`{}` when absent)."""
    fields = (
        "title STRING, url STRING, eventName STRING, eventBody STRING, projectId STRING, "
        "siteId STRING, userId STRING"
    )
    rows = messages.where(json_object(message).isNotNull())
    rows = rows.withColumn("__h5", F.from_json(message, fields)).drop(message)
    rows = rows.select(
        *rows.drop("__h5").columns,
        *[F.col("__h5")[f].alias(f) for f in ("title", "url", "projectId", "siteId", "userId")],
        F.coalesce(F.col("__h5.eventName"), F.lit("")).alias("eventName"),
        F.col("__h5.eventBody").alias("eventBody"),
    )
    return rows.withColumn("eventBody", F.coalesce(json_object("eventBody"), F.lit("{}")))


def encode(rows: DataFrame, name: str) -> DataFrame:
    """`eventName` and `eventBody` from the columns that `parse` gives: money as
    two-decimal text, flags as 0/1, NULLs left out."""
    wire = T.StructType.fromDDL(BODY[name].replace("DECIMAL(18,2)", "STRING"))
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in wire if f.name in rows.columns]
    kept = [c for c in rows.columns if c not in wire.fieldNames()]
    return rows.select(
        *kept, F.lit(name).alias("eventName"), F.to_json(F.struct(*fields)).alias("eventBody")
    )


def encode_custom(rows: DataFrame, name: str = "eventName", variables: str = "vars") -> DataFrame:
    """`eventBody` of events with a name of the caller's own, from their variables (a map), which
    are the whole body; the way back of `parse_custom`. Rows whose name is not made of letters,
    digits and underscores, or has a body of its own, are dropped."""
    rows = valid_custom_name(rows.withColumnRenamed(name, "eventName"))
    rows = rows.where(~F.col("eventName").isin(*KNOWN_EVENTS))
    body = F.to_json(F.coalesce(F.col(variables), F.create_map().cast("map<string,string>")))
    return rows.withColumn("eventBody", body).drop(variables)
