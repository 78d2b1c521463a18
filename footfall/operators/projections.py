"""Canonical columns from raw event parameters."""

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions import blank_to_null
from footfall.schema import KNOWN_EVENTS, SERIAL


def project_identity(raw: DataFrame) -> DataFrame:
    """Who sent the event, when, and its number. Empty texts become NULL."""
    return raw.withColumns(
        {
            "projectId": blank_to_null("projectId"),
            "siteId": blank_to_null("siteId"),
            "deviceId": blank_to_null("deviceId"),
            "userId": blank_to_null("userId"),
            "userProperty": blank_to_null("userProperty"),
            "eventTime": F.col("eventTime").try_cast("bigint"),
            "sn": F.col("sn").try_cast(SERIAL),
        }
    )


def _part(version: str, i: int) -> Column:
    return F.get(F.split(version, r"\."), F.lit(i))


def known_net(c="netType") -> Column:
    """Network label, with the two spellings of "unknown" as NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~c.isin("--", ""), c)


def project_device(raw: DataFrame, os_name: str = "iOS") -> DataFrame:
    """Device columns from `osVersion`, `appVersion`, `screenWidth`,
    `screenHeight`, `netType`, `language`. Missing version parts are NULL."""
    quoted_empty = F.lit('""')  # what the client sends for "not known"
    return raw.withColumns(
        {
            "uaOs": F.lit(os_name),
            "uaOsMajor": _part("osVersion", 0),
            "uaOsMinor": _part("osVersion", 1),
            "uaName": F.nullif("uaName", quoted_empty),
            "uaMajor": F.nullif("uaMajor", quoted_empty),
            "uaMinor": F.nullif("uaMinor", quoted_empty),
            "uaRevision": _part("appVersion", 2),
            "resolution": F.concat(  # NULL unless both are known
                F.col("screenWidth").cast("bigint").cast("string"), F.lit("*"),
                F.col("screenHeight").cast("bigint").cast("string"),
            ),
            "netType": known_net(),
        }
    )


def project_geo(raw: DataFrame) -> DataFrame:
    """Location as doubles, both or neither."""
    lat, lgt = F.col("lat").try_cast("double"), F.col("lgt").try_cast("double")
    known = lat.isNotNull() & lgt.isNotNull()
    return raw.withColumns({"lat": F.when(known, lat), "lgt": F.when(known, lgt)})


def project_version(events: DataFrame) -> DataFrame:
    """`appVersion` and `sdkVersion` out of `customerVar`."""
    parsed = F.from_json("customerVar", "appVersion STRING, sdkVersion STRING")
    return events.withColumn("__v", parsed).select(
        *[c for c in events.columns if c not in ("appVersion", "sdkVersion")], "__v.*"
    )


def encode_version(events: DataFrame, app_version, sdk_version) -> DataFrame:
    """`customerVar` from the versions; replaces what a caller had put there."""
    versions = F.struct(app_version.alias("appVersion"), sdk_version.alias("sdkVersion"))
    return events.withColumn("customerVar", F.to_json(versions))


def build_page_url(app, view, utm=None, push=None) -> Column:
    """`http://<app>/<view>` plus campaign and push content when there is a
    campaign. NULL and empty text both mean "none"."""
    return campaign_url(F.concat(F.lit("http://"), app, F.lit("/"), view), utm, push)


def campaign_url(url: Column, utm: Column | None, push: Column | None) -> Column:
    if utm is None:
        return url
    mark = F.when(url.contains("?"), "&").otherwise("?")
    tagged = F.concat(url, mark, F.lit("utm_campaign="), utm)
    if push is not None:
        content = F.concat(F.lit("&pushContent="), push)
        tagged = F.concat(tagged, F.when(F.length(push) > 0, content).otherwise(""))
    return F.when(F.length(utm) > 0, tagged).otherwise(url)


def merge_ud_variable(events: DataFrame) -> DataFrame:
    """`ud`: the caller's own variables. They sit under `udVariable`, but are
    the whole body of a custom event."""
    whole = F.from_json("eventBody", "MAP<STRING,STRING>")
    under = F.from_json("eventBody", "udVariable MAP<STRING,STRING>")["udVariable"]
    custom = ~F.coalesce(F.col("eventName").isin(*KNOWN_EVENTS), F.lit(False))
    return events.withColumn("ud", F.when(custom, whole).otherwise(under))


def parse_ua_header(df: DataFrame, header: str = "user_agent") -> DataFrame:
    """`App/Ver (Platform; iOS x)` as columns; NULL where it does not match."""
    pattern = r"^(.*)/([^/()]*) \((.*); iOS ([^;)]*)\)$"
    names = ("app_name", "app_version", "platform", "os_version")
    return df.withColumns(
        {
            name: F.when(F.col(header).rlike(pattern), F.regexp_extract(header, pattern, i + 1))
            for i, name in enumerate(names)
        }
    )


def action_path(df: DataFrame, app, screens="screens", prefix: str | None = None, named: int = 0) -> DataFrame:
    """Hierarchical screen names: `action_name`, its url, and all `levels` as an array; `named`
    adds that many columns level1, level2, ... to group by."""
    parts = F.col(screens)
    if prefix:
        parts = F.concat(F.array(F.lit(prefix)), parts)
    path = F.array_join(parts, "/")
    return df.withColumns(
        {
            "action_name": path,
            "url": F.concat(F.lit("http://"), app, F.lit("/"), path),
            "levels": parts,
            **{f"level{i + 1}": F.get(parts, F.lit(i)) for i in range(named)},
        }
    )
