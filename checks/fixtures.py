"""Event tables derived from the given tables.

The given tables are not clickstream data, so every row of `events`, `lineitem`,
`orders`, `customer` or `pages` is read as an event. The expressions below are
SQL that Spark and DuckDB read alike; only the base differs.
"""

from pyspark.sql import DataFrame, functions as F

DEVICE_SQL = "projectId, siteId, deviceId"

# -- events -> track events ------------------------------------------------------

EVENT_NAME = """
CASE event_type
  WHEN 'view' THEN 'pageview'
  WHEN 'click' THEN CASE WHEN k < 10 THEN 'openChannel' ELSE 'click' END
  WHEN 'signup' THEN CASE WHEN k < 60 THEN 'login' ELSE 'register' END
  WHEN 'purchase' THEN CASE WHEN k < 70 THEN 'payment' WHEN k < 85 THEN 'preCharge'
                            WHEN k < 92 THEN 'addCart' ELSE 'productPage' END
  ELSE CASE WHEN k < 10 THEN 'logout' WHEN k < 20 THEN 'jPush' WHEN k < 30 THEN 'initJPush'
            WHEN k < 45 THEN 'search' WHEN k >= 95 THEN 'bad name' ELSE 'error' END
END"""

EVENT_BODY = """
CASE eventName
  WHEN 'pageview' THEN CASE WHEN k % 2 = 0 THEN '{"udVariable":{"k":"' || k || '"}}' ELSE '{}' END
  WHEN 'search' THEN '{"keyword":"kw' || k || '","recommendationSearchFlag":' || (k % 2)
       || ',"historySearchFlag":' || (k % 3 % 2) || '}'
  WHEN 'productPage' THEN '{"sku":"s' || k || '","productCategory1":"c' || (k % 5) || '"'
       || CASE WHEN k % 2 = 0 THEN ',"productCategory2":"d' || (k % 3) || '"' ELSE '' END
       || ',"productOriginalPrice":"' || CAST(v + 1 AS DECIMAL(18,2)) || '","productRealPrice":"' || v || '"}'
  WHEN 'addCart' THEN '{"sku":"s' || k || '","productQuantity":' || k || ',"productRealPrice":"' || v || '"}'
  WHEN 'payment' THEN '{"orderID":"' || event_id || '","payMethod":"card","payStatus":' || (k % 2)
       || ',"payAMT":"' || v || '"}'
  WHEN 'preCharge' THEN '{"chargeAMT":"' || v || '","chargeMethod":"wallet","payStatus":' || (k % 2)
       || ',"couponAMT":"0.50"}'
  WHEN 'register' THEN '{"uid":"u' || user_id || '"' || CASE WHEN k % 3 = 0 THEN ',"type":"phone"' ELSE '' END
       || ',"authenticated":' || (k % 2) || '}'
  WHEN 'login' THEN '{}'
  WHEN 'logout' THEN '{"udVariable":{"k":"' || k || '"}}'
  WHEN 'click' THEN '{"eType":"' || CASE WHEN k % 3 = 0 THEN 'UITableView' ELSE 'UIButton' END
       || '","ePath":"Win/UITableViewWrapperView/View[' || k || ']/UITableViewWrapperView/UIButton"'
       || CASE WHEN k % 2 = 0 THEN ',"ePosition":"' || (k % 10) || ':' || (k % 7) || '"'
               WHEN k % 3 = 0 THEN ',"ePosition":"' || (k % 4) || '"' ELSE '' END
       || ',"eContent":"c' || k || '"}'
  WHEN 'jPush' THEN '{"pushInfo":' || CASE WHEN k % 2 = 1 THEN '{"alias":"a' || k || '"}' ELSE '{}' END
       || ',"pushContent":"' || CASE WHEN k % 5 = 0 THEN '' ELSE 'msg ' || k END
       || '","dcid":' || (k % 3) || ',"dtg":' || (k % 2) || '}'
  WHEN 'initJPush' THEN '{"pushManager":{"registrationID":"r' || k || '"}}'
  WHEN 'openChannel' THEN '{"openChannelName":"' || CASE WHEN k = 0 THEN '' ELSE 'ch' || k END || '"}'
  ELSE '{"level":"' || k || '"}'
END"""

TRACK = {
    "projectId": "'p1'",
    "siteId": "CASE WHEN user_id % 3 = 0 THEN 's2' ELSE 's1' END",
    "deviceId": "substr(md5(CAST(user_id AS STRING)), 1, 16)",
    "eventTime": "eventTime",
    # event ids grow with time, so they serve as serial numbers with gaps
    "sn": "CAST(event_id + 1 AS DECIMAL(20,0))",
    "eventName": "eventName",
    "eventBody": EVENT_BODY,
    "url": """CASE WHEN eventName = 'pageview' THEN 'http://app/p' || k
              || CASE WHEN k % 10 = 0 THEN '?x=1&y=a+b' ELSE '' END END""",
    "title": "CASE WHEN eventName = 'pageview' THEN 'page ' || k END",
    "userId": "CASE WHEN eventName = 'login' THEN 'u' || user_id END",
    "userProperty": """CASE WHEN eventName = 'login' AND k % 2 = 0
                       THEN '{"level":"' || (k % 5) || '","tag":"a&b"}' END""",
}

# event_id, user_id, k and v stay for the oracles
HELPERS = ("event_id", "user_id", "k", "v")

_BASE_SQL = f"""
base0 AS (
  SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS eventTime,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(value AS DECIMAL(18,2)) AS v
  FROM events),
base AS (SELECT *, {EVENT_NAME} AS eventName FROM base0)"""


def _columns(exprs: dict) -> list[str]:
    return [f"{e} AS {n}" for n, e in exprs.items()]


TRACK_SQL = f"""{_BASE_SQL},
track AS (SELECT {", ".join(HELPERS)}, {", ".join(_columns(TRACK))} FROM base)"""


def _base(spark, sf: str) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet")
    return _derived(events)


def _derived(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("eventTime"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.col("value").cast("decimal(18,2)").alias("v"),
    ).withColumn("eventName", F.expr(EVENT_NAME))


def track(spark, sf: str, *columns: str) -> DataFrame:
    """Track events; only the named columns when given."""
    return as_track(spark.read.parquet(f"{sf}/events.parquet"), *columns)


def as_track(events: DataFrame, *columns: str) -> DataFrame:
    wanted = {n: e for n, e in TRACK.items() if not columns or n in columns}
    extra = [h for h in HELPERS if h in columns]
    return _derived(events).selectExpr(*extra, *_columns(wanted))


# -- events -> raw parameters, as the wire has them --------------------------------

# fixed values: device codes and radio names
CODES = (
    "iPhone1,1", "iPhone7,1", "iPhone8,4", "iPhone9,4", "iPhone10,3", "iPod7,1", "iPad2,7",
    "iPad4,9", "iPad5,4", "iPad7,4", "i386", "x86_64", "Watch1,1",
)
RADIOS = (
    "CTRadioAccessTechnologyGPRS", "CTRadioAccessTechnologyEdge", "CTRadioAccessTechnologyWCDMA",
    "CTRadioAccessTechnologyHSDPA", "CTRadioAccessTechnologyHSUPA",
    "CTRadioAccessTechnologyCDMA1x", "CTRadioAccessTechnologyCDMAEVDORev0",
    "CTRadioAccessTechnologyeHRPD", "CTRadioAccessTechnologyLTE", "CTRadioAccessTechnologyNR",
)


def _choice(values) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE k % {len(values)} {whens} END"


RAW = {
    "event_id": "event_id",
    "k": "k",
    "projectId": "CASE WHEN k % 17 = 0 THEN ' ' ELSE 'p1' END",
    "siteId": "'s1'",
    "deviceId": "substr(md5(CAST(user_id AS STRING)), 1, 16)",
    "userId": "CASE WHEN k % 3 = 0 THEN '' WHEN k % 3 = 1 THEN 'u' || user_id END",
    "userProperty": """CASE WHEN k % 4 = 0 THEN '{"level":"' || k || '"}' END""",
    "eventTime": "CASE WHEN k = 49 THEN 'oops' ELSE CAST(eventTime AS STRING) END",
    "sn": "CASE WHEN k % 9 = 0 THEN '18446744073709551615' ELSE CAST(event_id + 1 AS STRING) END",
    "osVersion": "CASE WHEN k % 7 = 0 THEN '12' ELSE (10 + k % 4) || '.' || (k % 5) || '.1' END",
    "appVersion": "CASE WHEN k % 3 = 0 THEN '2.1' ELSE '2.1.' || k END",
    "uaName": """'""'""",
    "uaMajor": """CASE WHEN k % 2 = 0 THEN '""' ELSE '2' END""",
    "uaMinor": """'""'""",
    "screenWidth": "375.0 + k % 2 * 39",
    "screenHeight": "812.0 + k % 2 * 84",
    "screenScale": "CASE WHEN k % 2 = 0 THEN 3.0 ELSE 2.0 END",
    "netType": "CASE k % 4 WHEN 0 THEN '--' WHEN 1 THEN '' WHEN 2 THEN 'Wifi' ELSE '4G' END",
    "language": "'en'",
    "lat": "CASE WHEN k % 3 > 0 THEN CAST(30 + k % 5 AS STRING) || '.25' END",
    "lgt": "CASE WHEN k % 3 > 0 AND k % 5 > 0 THEN CAST(100 + k AS STRING) || '.5' END",
    "customerVar": """CASE WHEN k % 6 = 0 THEN '{"mine":"x"}'
                      ELSE '{"appVersion":"2.1.' || k || '","sdkVersion":"2.2.1"}' END""",
    "reachability": "CASE k % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'wifi' ELSE 'wwan' END",
    "radio": _choice(RADIOS),
    "deviceCode": _choice(CODES),
}
RAW_SQL = f"""{_BASE_SQL}, raw AS (SELECT {", ".join(_columns(RAW))} FROM base)"""


def raw(spark, sf: str) -> DataFrame:
    return _base(spark, sf).selectExpr(*_columns(RAW))


# -- lineitem -> order events -------------------------------------------------------

_LINE_BASE = {
    "ok": "l_orderkey",
    "ln": "l_linenumber",
    "pk": "l_partkey",
    "sk": "l_suppkey",
    "amt": "CAST(l_extendedprice AS DECIMAL(18,2))",
    "ship": "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.05 AS DECIMAL(4,2)) AS DECIMAL(18,2))",
    "disc": "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2))",
    "qty": "CAST(l_quantity AS INTEGER)",
}
LINE_ORDER_ID = "CASE ln WHEN 7 THEN '' WHEN 6 THEN NULL ELSE ok || '-' || ln END"
LINE_BODY = f"""
'{{"orderInfo":{{' || coalesce('"orderID":"' || {LINE_ORDER_ID} || '",', '')
 || '"orderAMT":"' || amt || '","shipAMT":"' || ship || '"'
 || CASE WHEN pk % 2 = 0 THEN ',"shipMethod":"air"' ELSE '' END || '}}'
 || CASE WHEN disc > 0 THEN ',"couponInfo":[{{"couponType":"discount","couponAMT":"' || disc || '"}}'
      || CASE WHEN qty > 40 THEN ',{{"couponAMT":"1.00"}}' ELSE '' END || ']' ELSE '' END
 || CASE WHEN ln < 5 THEN ',"productInfo":[{{"sku":"p' || pk || '","productCategory":"c' || (pk % 5)
      || '","productRealPrice":"' || CAST(amt - ship AS DECIMAL(18,2)) || '","productOriPrice":"'
      || CASE WHEN pk % 4 = 0 THEN '-1.00' ELSE CAST(amt AS STRING) END
      || '","productQuantity":' || qty
      || CASE WHEN pk % 5 = 0 THEN '' ELSE ',"productTitle":"t' || pk || '"' END || '}}'
      || CASE WHEN qty > 25 THEN ',{{"sku":"g' || sk || '","productCategory":"","productRealPrice":"1.00",'
           || '"productOriPrice":"-1.00","productQuantity":1,"productTitle":"gift"}}' ELSE '' END
      || ']' ELSE '' END
 || '}}'"""
ORDER_EVENT = {
    "projectId": "'p1'",
    "siteId": "'s1'",
    "deviceId": "substr(md5('s' || sk), 1, 16)",
    "eventTime": "ok * 1000 + ln",
    "sn": "CAST(ok * 10 + ln AS DECIMAL(20,0))",
    "eventName": "'order'",
    "eventBody": LINE_BODY,
}
LINES_SQL = f"""lines AS (SELECT {", ".join(_columns(_LINE_BASE))} FROM lineitem)"""


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """The rows of a given table over all cores: its one row group is read by one task."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, *by)


def order_events(spark, sf: str) -> DataFrame:
    """One order event per lineitem row, with up to two products and coupons."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(*_columns(_LINE_BASE))
    return spread(lines, "ok", "ln", "pk", "sk").selectExpr(*_columns(ORDER_EVENT))
