"""Page context and one-shot campaign attribution."""

from pyspark.sql import Column, functions as F

from footfall.operators.projections import campaign_url
from footfall.operators.timeline import on_timeline
from footfall.schema import OPEN_CHANNEL, PAGEVIEW, PUSH, PUSH_CAMPAIGN


def _is(name: str) -> Column:
    return F.coalesce(F.col("eventName") == name, F.lit(False))


@on_timeline
def page_context(events):
    """Fill `url` and `title` from the latest page view, and set `referrer` to
    the url of the page view before that one. The state outlives sessions."""
    moves = _is(PAGEVIEW) & F.col("url").isNotNull()
    url = F.when(moves, F.col("url"))
    title = F.when(_is(PAGEVIEW), F.col("title"))
    return (
        events.fill(last={"__url": url, "__title": title}, before={"__came": url})
        # in a struct, so that "no page before" is remembered too
        .set(__came=F.when(moves, F.struct(F.col("__came").alias("from"))))
        .last(__came=F.col("__came"))
        .set(
            url=F.coalesce("url", "__url"),
            title=F.coalesce("title", "__title"),
            referrer=F.col("__came.from"),
        )
        .drop("__url", "__title", "__came")
    )


@on_timeline
def legacy_page_url(events, app, views: Column | None = None):
    """Url of a legacy row without one: the latest page url, else the app's.
    `views` tells the rows that set it; by default page views, and in a legacy
    table the rows with an action name."""
    if views is None:
        named = "eventName" in events.columns
        views = _is(PAGEVIEW) if named else F.col("action_name").isNotNull()
    return (
        events.last(__url=F.when(views, F.col("url")))
        .set(url=F.coalesce("url", "__url", F.concat(F.lit("http://"), app)))
        .drop("__url")
    )


#: A url that the client has tagged already.
TAGGED = r"[?&]utm_campaign="


@on_timeline
def attribute_campaign(events, native: Column | None = None):
    """`utm`, `pushContent` and the tagged `url` on page views.

    A channel opening sets the campaign to its name, a push to a fixed one and
    sets the push content. The next native page view takes both, if the campaign
    is not empty. A channel replaces the campaign but leaves old push content in
    place, which then goes out with the later campaign.
    """
    if native is None:
        native = F.col("bridgeInfo").isNull() if "bridgeInfo" in events.columns else F.lit(True)
    at = F.col("__at")
    views = _is(PAGEVIEW) & native
    channel = F.coalesce(F.get_json_object("eventBody", "$.openChannelName"), F.lit(""))
    content = F.coalesce(F.get_json_object("eventBody", "$.pushContent"), F.lit(""))
    campaign = F.when(_is(OPEN_CHANNEL), F.struct(at.alias("at"), channel.alias("name"))).when(
        _is(PUSH), F.struct(at.alias("at"), F.lit(PUSH_CAMPAIGN).alias("name"))
    )
    pushed = F.when(_is(PUSH), F.struct(at.alias("at"), content.alias("text")))

    def fresh(setter, used, value):
        return (setter["at"] > F.coalesce(used, F.lit(0))) & (F.length(value) > 0)

    setter, push = F.col("__campaign"), F.col("__push")
    # the client tags a url before it sends it: such a url says what it carries
    tagged = views & F.coalesce(F.col("url").rlike(TAGGED), F.lit(False))
    carried = lambda name: F.nullif(F.regexp_extract("url", rf"[?&]{name}=([^&#]*)", 1), F.lit(""))
    utm = F.when(tagged, carried("utm_campaign")).when(
        views & fresh(setter, F.col("__viewed"), setter["name"]), setter["name"]
    )
    text = F.when(tagged, carried("pushContent")).when(
        F.col("utm").isNotNull() & fresh(push, F.col("__used"), push["text"]), push["text"]
    )
    return (
        events.total(__at=F.lit(1).cast("bigint"))
        .before(__campaign=campaign, __push=pushed, __viewed=F.when(views, at))
        .set(utm=utm)
        .before(__used=F.when(F.col("utm").isNotNull(), at))
        .set(pushContent=text)
        .set(url=F.when(tagged, F.col("url")).otherwise(campaign_url(F.col("url"), F.col("utm"), F.col("pushContent"))))
        .drop("__at", "__campaign", "__push", "__viewed", "__used")
    )
