"""The legacy protocol: mapping to it, and reading its fields."""

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions import json_object, local_millis, utc_text
from footfall.operators.context import legacy_page_url
from footfall.operators.filters import legacy_eligible
from footfall.operators.timeline import on_timeline
from footfall.schema import (
    CUSTOM_DIMENSION_SLOT, DEVICE_INFO_SLOT, LOGIN, PAGEVIEW, SEARCH, SERIAL, SERIAL_LABEL,
    SYSTEM_SLOT,
)

# Names that go with the custom variable slots.
SLOT_NAMES = {
    DEVICE_INFO_SLOT: "device_info",
    CUSTOM_DIMENSION_SLOT: "customvariable",
    SYSTEM_SLOT: "systemvariable",
}

# Labels inside the device info text, with their column names.
DEVICE_INFO_LABELS = {
    "App_Name": "app_name",
    "App_Version": "app_version",
    "OS_Version": "os_version",
    "Platform": "platform",
    "SDK_Version": "sdk_version",
    "Push_ClientId": "push_client_id",
    "Push_Type": "push_type",
}


def to_legacy(events: DataFrame) -> DataFrame:
    """Legacy fields of current events; identity columns stay. One row per event
    that the legacy protocol gets. Add `legacy_order_items` columns beforehand
    to have order item rows mapped as well."""
    rows = legacy_eligible(events)
    for absent in ("userId", "url", "title", "ec_items", "ec_id", "revenue", "ec_sh", "ec_st"):
        if absent not in rows.columns:
            rows = rows.withColumn(absent, F.lit(None).cast("string"))

    name, body = F.col("eventName"), F.col("eventBody")
    # an event without a name is neither
    page = F.coalesce(name == PAGEVIEW, F.lit(False)) & body.isNotNull()
    search = F.coalesce(name == SEARCH, F.lit(False))
    has_items = F.col("ec_items").isNotNull()

    # the body again, for a login with the user in it
    given = F.coalesce(json_object("eventBody"), F.lit("{}"))  # a bad body counts as empty
    with_user = F.when(
        F.col("userId").isNull() | F.get_json_object(given, "$.uid").isNotNull(), given
    ).otherwise(
        F.concat(
            F.regexp_replace(given, r"\}\s*$", ""),
            F.when(given.rlike(r"^\s*\{\s*\}\s*$"), "").otherwise(","),
            F.lit('"uid":'),
            F.regexp_extract(F.to_json(F.struct(F.col("userId").alias("uid"))), r'^\{"uid":(.*)\}$', 1),
            F.lit("}"),
        )
    )
    text = F.when(name == LOGIN, with_user).otherwise(body)
    dimension = F.from_json(body, "udVariable MAP<STRING,STRING>")["udVariable"]

    return rows.withColumns(
        {
            "e_c": F.when(~page & ~search, "event1.0"),
            "e_a": F.when(~search, name),
            "e_n": F.when(
                ~page & ~search, F.coalesce(text, F.when(has_items, ""))
            ),
            "search": F.when(search, F.get_json_object(body, "$.keyword")),
            "action_name": F.when(page, F.col("title")),
            "title": F.when(page, F.col("title")),
            "url": F.when(page, F.col("url")),
            "new_visit": F.when(page & F.col("url").contains("utm_campaign"), "1"),
            "customvariable": F.when(page & (F.size(dimension) > 0), encode_dimension(dimension)),
            "idgoal": F.when(has_items, "0"),
            "revenue": F.when(has_items, F.col("revenue")),
            "ec_sh": F.when(has_items, F.col("ec_sh")),
            "ec_st": F.when(has_items, F.col("ec_st")),
            "ec_tx": F.lit("0"),
        }
    )


def _hash_number(*names) -> Column:
    key = F.concat_ws(":", *names)
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def legacy_request_time(events: DataFrame, tz="UTC") -> DataFrame:
    """Unpadded wall clock h, m, s in `tz`, UTC text `cdt`, `uid`, and `r`: a
    number below 50000 that is the same on every run."""
    clock = F.floor(local_millis("eventTime", tz) / 1000)
    hour, minute = F.floor(clock / 3600), F.floor(clock / 60)
    return events.withColumns(
        {
            "h": F.pmod(hour, F.lit(24)).cast("string"),
            "m": F.pmod(minute, F.lit(60)).cast("string"),
            "s": F.pmod(clock, F.lit(60)).cast("string"),
            "cdt": utc_text("eventTime"),
            "uid": F.when(F.length("userId") > 0, F.col("userId")),
            "r": F.pmod(_hash_number("deviceId", "eventTime", "sn"), F.lit(50000)).cast("string"),
        }
    )


def legacy_static(events: DataFrame, width="screenWidth", height="screenHeight", scale="screenScale") -> DataFrame:
    """Site, protocol version, visitor id, and the screen size in pixels where the
    table has it."""

    def pixels(side):
        if side not in events.columns:
            return F.lit(None).cast("string")
        return F.round(F.col(side) * F.col(scale)).cast("bigint").cast("string")

    return events.withColumns(
        {
            "idsite": F.col("siteId"),
            "rec": F.lit("1"),
            "apiv": F.lit("1"),
            "res": F.concat(pixels(width), F.lit("x"), pixels(height)),
            "_id": F.col("deviceId"),
            "send_image": F.lit("0"),
        }
    )


# -- custom variables ----------------------------------------------------------


def encode_custom_vars(slots: dict[str, tuple]) -> Column:
    """`{"idx":[name,value],...}` of the slots whose value is not NULL, ascending
    by index; NULL when there is none. `slots`: index -> (name, value column)."""
    entries = [
        F.when(
            value.isNotNull(),
            F.struct(F.lit(slot).alias("k"), F.array(F.lit(name), value).alias("v")),
        )
        for slot, (name, value) in sorted(slots.items())
    ]
    held = F.filter(F.array(*entries), lambda e: e.isNotNull())
    return F.when(F.size(held) > 0, F.to_json(F.map_from_entries(held)))


def request_vars(rows: DataFrame) -> DataFrame:
    """`cvar` of a legacy row: the custom dimension, and the serial number unless
    the row is an order, a goal or a search."""
    plain = F.col("ec_id").isNull() & F.col("idgoal").isNull() & F.col("search").isNull()
    serial = F.concat(F.lit("{" + SERIAL_LABEL + ":"), F.col("sn").cast("string"), F.lit("}"))
    slots = {
        CUSTOM_DIMENSION_SLOT: (SLOT_NAMES[CUSTOM_DIMENSION_SLOT], F.col("customvariable")),
        SYSTEM_SLOT: (SLOT_NAMES[SYSTEM_SLOT], F.when(plain, serial)),
    }
    return rows.withColumn("cvar", encode_custom_vars(slots))


def decode_custom_vars(rows: DataFrame, cvar: str = "cvar") -> DataFrame:
    """`vars` index -> [name, value], and one column per slot with a fixed name."""
    rows = rows.withColumn("vars", F.from_json(cvar, "MAP<STRING,ARRAY<STRING>>"))
    return rows.withColumns(
        {name: F.get(F.col("vars")[slot], F.lit(1)) for slot, name in SLOT_NAMES.items()}
    )


def collect_vars(settings: DataFrame, event=("event_id",), order="position") -> DataFrame:
    """Custom variables per event from (event, idx, name, value, position) rows;
    of one index the last write wins. Reduced to one row per index first, so the
    collected map is as small as the set of indexes."""
    latest = settings.groupBy(*event, "idx").agg(
        F.max_by(F.array("name", "value"), order).alias("v")
    )
    entry = F.struct(F.col("idx").cast("string").alias("k"), "v")
    return latest.groupBy(*event).agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("vars")
    )


def encode_dimension(variables: Column) -> Column:
    """`[{keyName:k, keyValue:v},...]`, keys ascending. Not JSON."""
    items = F.transform(
        F.array_sort(F.map_entries(variables)),
        lambda e: F.concat(
            F.lit("{keyName:"), e["key"], F.lit(", keyValue:"), F.coalesce(e["value"], F.lit("")), F.lit("}")
        ),
    )
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def custom_dimension(text: Column) -> Column:
    """Map out of `encode_dimension` text; values that hold `},{` are ambiguous.
    A repeated key keeps its first value."""
    pattern = r"\{keyName:(.*?), keyValue:(.*?)\}(?=,\{keyName:|\]$)"
    keys = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    entries = F.filter(
        F.arrays_zip(keys.alias("k"), values.alias("v")),
        lambda e, i: F.array_position(keys, e["k"]) == i + 1,
    )
    return F.map_from_entries(entries)


def decode_custom_dimension(rows: DataFrame, text: str = "customvariable") -> DataFrame:
    return rows.withColumn("dimension", custom_dimension(F.col(text)))


def parse_lifetime_seq(rows: DataFrame, cvar: str = "cvar") -> DataFrame:
    """`lifetime_seq`: serial number in slot 5, NULL when it is not there."""
    slot = F.get_json_object(cvar, f"$['{SYSTEM_SLOT}']")
    digits = F.regexp_extract(slot, SERIAL_LABEL + r":\s*(\d+)", 1)
    return rows.withColumn("lifetime_seq", digits.try_cast(SERIAL))


def decode_device_info(rows: DataFrame, text: str = "device_info") -> DataFrame:
    """Columns out of `{App_Name : a, App_Version : b, ...}`; a value ends where
    the next label starts, so values may hold commas."""
    labels = "|".join(DEVICE_INFO_LABELS)

    def value(label):
        pattern = rf"[{{,]\s*{label}\s*:\s*(.*?)\s*(?=,\s*(?:{labels})\s*:|\}}$)"
        return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))

    return rows.withColumns({name: value(label) for label, name in DEVICE_INFO_LABELS.items()})


def encode_device_info(columns: dict[str, Column]) -> Column:
    """Inverse of `decode_device_info`; the push part only when both are known."""
    five = list(DEVICE_INFO_LABELS)[:5]
    base = F.concat_ws(", ", *[F.concat(F.lit(f"{n} : "), columns[n]) for n in five])
    push = F.concat(
        F.lit(", Push_ClientId: "), columns.get("Push_ClientId", F.lit(None).cast("string")),
        F.lit(", Push_Type: "), columns.get("Push_Type", F.lit(None).cast("string")),
    )
    return F.concat(F.lit("{"), base, F.coalesce(push, F.lit("")), F.lit("}"))


# -- direct legacy rows ---------------------------------------------------------


@on_timeline
def legacy_category_event(events, app, category, action, name=None, value=None, when=None):
    """Category events of the legacy protocol: `e_c`, `e_a`, optional `e_n` and
    `e_v`, and the url of the latest page view. The arguments are columns;
    `when` selects the rows (all rows by default) after the url is known."""
    none = F.lit(None).cast("string")
    rows = legacy_page_url(events, app)
    rows = rows if when is None else rows.where(when)
    return rows.set(
        e_c=category,
        e_a=action,
        e_n=none if name is None else name,
        e_v=none if value is None else value,
    )


def find_target_group(
    rows: DataFrame, message: str, key: str = "target_group_id"
) -> DataFrame:
    """Value of `key` in nested objects, and in JSON objects held by text; the
    least deep hit wins, then the first in document order.

    Read as a map of texts, a nested object and a text that holds one look alike, so each
    level is the same step inside the row, folded as often as the message opens objects;
    nothing is exploded, joined or cut off.
    """
    as_map = "MAP<STRING,STRING>"

    def step(state, _):
        maps = F.filter(F.transform(state["texts"], lambda t: F.from_json(t, as_map)), F.isnotnull)

        def descend(m):  # `m` is read twice but parsed once
            hits = F.filter(F.transform(m, lambda x: x[key]), F.isnotnull)
            inner = F.filter(F.flatten(F.transform(m, F.map_values)), lambda t: t.rlike(r"^\s*\{"))
            return F.struct(inner.alias("texts"), F.get(hits, F.lit(0)).alias("hit"))

        below = F.get(F.transform(F.array(maps), descend), F.lit(0))
        return F.when(state["hit"].isNotNull(), state).otherwise(below)

    text = F.col(message)
    opened = F.regexp_count(text, F.lit(r"\{|u007[bB]"))  # at least the depth
    start = F.struct(F.array(text).alias("texts"), F.lit(None).cast("string").alias("hit"))
    levels = F.sequence(F.lit(1), opened)
    found = F.when(opened > 0, F.aggregate(levels, start, step, lambda s: s["hit"]))
    return rows.withColumn(key, found)
