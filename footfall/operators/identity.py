"""Who was signed in, carried along the events of a device."""

from pyspark.sql import Column, DataFrame, functions as F

from footfall.operators.timeline import on_timeline
from footfall.schema import DEVICE, LOGIN, LOGOUT, PUSH_INIT, REGISTER, USER_HORIZON_S
from footfall.scratch import hand_over


def _logs_out(cleared) -> Column:
    left = F.col("eventName") == LOGOUT
    if cleared is not None:
        left = left & cleared
    return F.coalesce(left, F.lit(False))


def _carry(events, column: str, ends: Column, empties: Column | None = None):
    """Own value, else the latest one since the latest `ends` row. That row still
    has the value; it is cleared after it. An `empties` row clears it before itself."""
    own = F.col(column)
    empties = F.lit(False) if empties is None else empties
    state = F.when(ends | empties, F.struct(F.lit(None).cast("string").alias("v"))).when(
        own.isNotNull(), F.struct(own.alias("v"))
    )
    value = F.when(~empties, F.coalesce(own, F.col("__state.v")))
    return events.before(__state=state).set(**{column: value}).drop("__state")


@on_timeline
def carry_user(events, clears: Column | None = None):
    """A login sets the user from that event on; a logout clears it after itself.
    `clears` tells the logouts that do (all by default): the wire does not show
    which of the client's two logout calls was used, and one keeps the user. The login of an
    embedded page (a row with `bridgeInfo`) sets what it names: without a user it clears."""
    nobody = None
    if "bridgeInfo" in events.columns:
        nobody = F.coalesce(F.col("eventName") == LOGIN, F.lit(False)) & F.col("bridgeInfo").isNotNull()
        nobody = nobody & (F.coalesce("userId", F.lit("")) == "")
    return _carry(events, "userId", _logs_out(clears), nobody)


@on_timeline
def carry_user_property(events):
    """User properties hold until any logout."""
    return _carry(events, "userProperty", _logs_out(None))


@on_timeline
def carry_registration(events):
    """`registrationID` of the latest push set-up, on register and login rows."""
    token = F.when(
        F.col("eventName") == PUSH_INIT,
        F.get_json_object("eventBody", "$.pushManager.registrationID"),
    )
    takes = F.col("eventName").isin(REGISTER, LOGIN)
    return (
        events.last(__token=token)
        .set(registrationID=F.when(takes, F.col("__token")))
        .drop("__token")
    )


@on_timeline
def backfill_user(events, horizon_s: int = USER_HORIZON_S):
    """Give events without a user the next user seen on the device, if it shows
    up within the horizon (the time an event waits in the device queue)."""
    user = F.col("userId")
    seen = F.when(user.isNotNull(), F.struct(user.alias("id"), F.col("eventTime").alias("at")))
    soon = F.col("__seen.at") - F.col("eventTime") <= horizon_s * 1000
    return (
        events.next(__seen=seen)
        .set(userId=F.coalesce(user, F.when(soon, F.col("__seen.id"))))
        .drop("__seen")
    )


def backfill_between(
    batch: DataFrame, held: DataFrame | None = None, horizon_s: int = USER_HORIZON_S, until_ms: int | None = None, hot=None,
) -> tuple[DataFrame, DataFrame]:
    """`backfill_user` over the edge of two runs: (rows whose user is settled, rows to hold).

    A row without a user waits while its device may still name one within the horizon: until
    the device has a later event, or the time `until_ms` has come. `held` are the rows that the
    run before held. The settled rows of all runs and what the last one holds are the rows of
    one run over everything, if each device's events come in order."""
    rows = batch if held is None else batch.unionByName(held)
    newest = rows.groupBy(*DEVICE).agg(F.max("eventTime").alias("__newest")).alias("d")
    line = backfill_user(rows, horizon_s, hot=hot).alias("r")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"d.{c}")) for c in DEVICE]
    limit = F.col("eventTime") + horizon_s * 1000
    waits = F.col("userId").isNull() & (limit >= F.col("__newest"))
    if until_ms is not None:
        waits = waits & (limit >= until_ms)
    marked = hand_over(
        line.join(newest, same).select("r.*", F.coalesce(waits, F.lit(False)).alias("__waits")), "backfill"
    )
    return marked.where("NOT __waits").drop("__waits"), marked.where("__waits").drop("__waits")


@on_timeline
def resolve_user(events, horizon_s: int = USER_HORIZON_S, clears: Column | None = None):
    """The user of every event, from both directions."""
    return backfill_user(carry_user(events, clears), horizon_s)
