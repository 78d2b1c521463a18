"""Bulk request bodies: `{"requests":["?k=v&k=v", ...]}`.

Decoding is map-only. Values may hold an unescaped `&`, so an item is cut only
where a known parameter name follows.
"""

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions import escape_value, unescape_value
from footfall.operators.delivery import batch_index
from footfall.operators.legacy import parse_lifetime_seq
from footfall.schema import (
    DEVICE, ESCAPED_COLUMNS, EVENT_COLUMNS, EVENT_SCHEMA, EVENTS_PER_REQUEST,
    LEGACY_COLUMNS, LEGACY_ESCAPED, LEGACY_RESERVED, RESERVED_COLUMNS, SERIAL,
)

# Characters a request body keeps unescaped besides letters, digits
# and `-._*`.
_KEPT_IN_BODY = "!$&'()+,/:;=?@~"


def _percent_decode(body: Column) -> Column:
    # url_decode reads `+` as a space; on this wire it is a plain plus sign
    return F.try_url_decode(F.replace(body, F.lit("+"), F.lit("%2B")))


def _percent_encode(body: Column) -> Column:
    # url_encode escapes more than this wire does. The escapes to keep have their
    # own % escaped, so that one url_decode takes back only the others.
    kept = "|".join(f"{ord(c):02X}" for c in _KEPT_IN_BODY)
    spaced = F.replace(F.url_encode(body), F.lit("+"), F.lit("%20"))
    return F.url_decode(F.regexp_replace(spaced, f"%(?!{kept})", "%25"))


def _items(payloads: DataFrame, body: Column) -> DataFrame:
    parsed = F.from_json(body, "requests ARRAY<STRING>")["requests"]
    return payloads.select("*", F.posexplode_outer(parsed).alias("position", "item"))


def _decode(payloads, body, columns, reserved, types, escaped) -> DataFrame:
    names = "|".join((*columns, *reserved))
    pieces = F.split(F.regexp_replace("item", r"^\?", ""), f"&(?=(?:{names})=)")
    rows = (
        _items(payloads, body)
        # last piece first: a search then finds the last value of a repeated name
        .withColumn("__pieces", F.reverse(pieces))
        .withColumn("__names", F.transform("__pieces", lambda p: F.substring_index(p, "=", 1)))
    )

    def value(name):
        piece = F.get("__pieces", F.array_position("__names", name).cast("int") - 1)
        raw = F.substr(piece, F.lit(len(name) + 2))
        raw = unescape_value(raw) if name in escaped else raw
        return raw.try_cast(types[name].dataType) if name in types else raw

    known = F.array(*[F.lit(c) for c in columns])
    others = F.filter(
        F.arrays_zip(F.col("__names").alias("k"), F.col("__pieces").alias("v")),
        lambda e, i: e["v"].contains("=")
        & ~F.array_contains(known, e["k"])
        & (F.array_position("__names", e["k"]) == i + 1),
    )
    extra = F.transform(
        others,
        lambda e: F.struct(e["k"].alias("k"), F.substr(e["v"], F.length(e["k"]) + 2).alias("v")),
    )
    return rows.select(
        *[c for c in payloads.columns if c != "body"],
        "position",
        F.col("item").isNull().alias("malformed"),
        *[value(c).alias(c) for c in columns],
        F.map_from_entries(extra).alias("extra"),
    )


def decode_bulk_v2(payloads: DataFrame) -> DataFrame:
    """`body` (percent-escaped JSON) to one row per event. A body that cannot be
    read gives one row with `malformed` set; send those to quarantine."""
    types = {f.name: f for f in EVENT_SCHEMA}
    return _decode(
        payloads, _percent_decode(F.col("body")), EVENT_COLUMNS, RESERVED_COLUMNS,
        types, ESCAPED_COLUMNS,
    )


def decode_bulk_v1(payloads: DataFrame) -> DataFrame:
    """`body` (plain JSON) to one row per legacy event, all values as text."""
    return _decode(
        payloads, F.col("body"), LEGACY_COLUMNS, LEGACY_RESERVED, {}, LEGACY_ESCAPED
    )


def escape_params(events: DataFrame, columns=None) -> DataFrame:
    """Escape `?` and `&` in all text columns (or the named ones)."""
    return _over_text(events, escape_value, columns)


def unescape_params(events: DataFrame, columns=None) -> DataFrame:
    return _over_text(events, unescape_value, columns)


def _over_text(events, change, columns) -> DataFrame:
    text = [name for name, kind in events.dtypes if kind == "string"]
    return events.withColumns({c: change(c) for c in text if columns is None or c in columns})


def query_string(events: DataFrame, columns, escaped=(), reserved=()) -> Column:
    """`?k=v&k=v` of the non-null columns, in the order given, then of what `extra` holds under
    the `reserved` names, which is all that decoding puts there."""
    present = [c for c in columns if c in events.columns]

    def pair(c):
        text = F.col(c).cast("string")
        return F.concat(F.lit(c + "="), escape_value(text) if c in escaped else text)

    more = [F.concat(F.lit(k + "="), F.col("extra")[k]) for k in reserved if "extra" in events.columns]
    # concat_ws leaves out NULLs
    return F.concat(F.lit("?"), F.concat_ws("&", *[pair(c) for c in present], *more))


def _encode(queued, keys, order, n) -> DataFrame:
    """`queued` has keys, order columns, `batch` and `query`. A request holds at
    most n events, so the collected list is bounded."""
    listed = F.array_sort(F.collect_list(F.struct(*order, "query")))
    return (
        queued.groupBy(*keys, "batch")
        .agg(listed.alias("__sorted"), F.count("*").alias("n_events"))
        .withColumn(
            "body",
            F.to_json(F.struct(F.transform("__sorted", lambda e: e["query"]).alias("requests"))),
        )
        .drop("__sorted")
    )


def encode_bulk(events: DataFrame, n: int = EVENTS_PER_REQUEST, hot=None) -> DataFrame:
    """Oldest-first requests of n events per device, percent-escaped. Events with equal time and
    number go by what is sent of them, so a run that is repeated makes the same requests."""
    queued = events.withColumn("query", query_string(events, EVENT_COLUMNS, ESCAPED_COLUMNS, RESERVED_COLUMNS))
    queued = queued.select(*DEVICE, "eventTime", F.coalesce("sn", F.lit(0)).alias("sn"), "query")
    queued = batch_index(queued, n, order=("eventTime", "sn", "query"), hot=hot)
    return _encode(queued, DEVICE, ("eventTime", "sn"), n).withColumn("body", _percent_encode("body"))


def encode_bulk_v1(legacy: DataFrame, n: int = EVENTS_PER_REQUEST, hot=None) -> DataFrame:
    """The same for legacy rows, ordered by (cdt, Lifetime_seq), rows without the
    latter last; the body is not percent-escaped."""
    queued = legacy.withColumn("query", query_string(legacy, LEGACY_COLUMNS, LEGACY_ESCAPED, LEGACY_RESERVED))
    last = F.lit("9" * 20).cast(SERIAL)
    seq = F.coalesce("lifetime_seq", last).alias("seq")
    queued = parse_lifetime_seq(queued).select("idsite", "deviceId", "cdt", seq, "query")
    keys, order = ("idsite", "deviceId"), ("cdt", "seq")
    queued = batch_index(queued, n, keys=keys, order=(*order, "query"), hot=hot)
    return _encode(queued, keys, order, n)
