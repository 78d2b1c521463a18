"""Which rows an operator may see."""

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions import json_object
from footfall.schema import DEVICE, OPEN_CHANNEL, PUSH, PUSH_INIT, SCREEN_DENYLIST


def valid_custom_name(events: DataFrame, name: str = "eventName") -> DataFrame:
    r"""Names made of letters, digits and `_` only (`\z`: no trailing newline)."""
    return events.where(F.col(name).rlike(r"\A[a-zA-Z_0-9]+\z"))


def valid_order(orders: DataFrame, order_id: str = "orderID") -> DataFrame:
    """Drop orders whose id is empty text; a missing id passes."""
    return orders.where(F.coalesce(F.col(order_id) != "", F.lit(True)))


def valid_push(pushes: DataFrame) -> DataFrame:
    """Pushes that name an alias, a registration id or a tag."""
    return pushes.where(F.coalesce("alias", "registrationID", "tag").isNotNull())


def valid_transaction(transactions: DataFrame) -> DataFrame:
    """Legacy transactions with an id, a total, and a sku on every item."""
    skus = F.forall("items", lambda item: F.coalesce(F.length(item["sku"]) > 0, F.lit(False)))
    return transactions.where(
        (F.length("identifier") > 0)
        & F.col("grandTotal").isNotNull()
        & F.coalesce(skus, F.lit(True))
    )


def _not_listed(rows: DataFrame, column: str, listed) -> DataFrame:
    # a table of names is joined, Spark choosing by its size; a short Python
    # list becomes a literal set
    if isinstance(listed, DataFrame):
        names = listed.select(F.col(listed.columns[0]).alias("__listed")).distinct()
        return rows.join(names, rows[column] == names["__listed"], "left_anti")
    return rows.where(F.coalesce(~F.col(column).isin(*listed), F.lit(True))) if listed else rows


def screen_denylist(views: DataFrame, extra=(), screen: str = "screen") -> DataFrame:
    """Drop page views of system screens and of those named in `extra` (a list
    or a one-column table)."""
    views = _not_listed(views, screen, SCREEN_DENYLIST)
    return _not_listed(views, screen, extra)


def control_denylist(clicks: DataFrame, denied, e_type: str = "eType") -> DataFrame:
    """Drop clicks on the named kinds of control."""
    return _not_listed(clicks, e_type, denied)


def native_screens(views: DataFrame, extra=(), screen="screen", flag="has_web_view") -> DataFrame:
    """Automatic page views: no web view on screen, not denied."""
    return screen_denylist(views.where(~F.coalesce(F.col(flag), F.lit(False))), extra, screen)


def legacy_eligible(events: DataFrame) -> DataFrame:
    """Events that the legacy protocol also gets, those without a name included."""
    return events.where(~F.coalesce(F.col("eventName").isin(PUSH_INIT, PUSH, OPEN_CHANNEL), F.lit(False)))


def not_opted_out(events: DataFrame, opted_out: DataFrame, keys=DEVICE) -> DataFrame:
    """Drop devices on the opt-out table."""
    return events.join(opted_out.select(*keys).distinct(), list(keys), "left_anti")


def sample_bucket(key: Column) -> Column:
    """0 to 100, the same on every run for the same key."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(101))


def sample_events(events: DataFrame, rate: int = 100, key: Column | None = None) -> DataFrame:
    """Keep about (rate + 1) / 101 of the events, 100 keeping all. The choice
    hangs on device and serial number, so it can be repeated."""
    if rate == 100:
        return events
    if key is None:
        key = F.concat_ws(":", "deviceId", "sn")
    return events.where(sample_bucket(key) <= rate)


def reject_malformed(rows: DataFrame, message: str = "message") -> tuple[DataFrame, DataFrame]:
    """(rows whose message is a JSON object, the rest for quarantine)."""
    good = json_object(message).isNotNull()
    return rows.where(good), rows.where(~good)
