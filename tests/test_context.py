from pyspark.sql import functions as F

from footfall.operators import context, identity
from tests.helpers import DAY, column, events


def view(at, url=None, title=None, **more):
    return (DAY + at, "pageview", {"url": url, "title": title, **more})


def test_page_context(spark):
    out = context.page_context(events(
        spark,
        (DAY, "click"),
        view(1, "u1", "t1"),
        (DAY + 2, "click"),
        view(3, None, "t2"),
        (DAY + 4, "click"),
        view(2_000_000, "u2", "t3"),
        (DAY + 2_000_001, "click", {"url": "own", "title": "mine"}),
    ))
    assert column(out, "url") == [None, "u1", "u1", "u1", "u1", "u2", "own"]
    assert column(out, "title") == [None, "t1", "t1", "t2", "t2", "t3", "mine"]
    assert column(out, "referrer") == [None, None, None, None, None, "u1", "u1"]


def test_legacy_page_url(spark):
    rows = events(spark, (DAY, "click"), view(1, "u1"), (DAY + 2, "click"), (DAY + 3, "x", {"url": "own"}))
    assert column(context.legacy_page_url(rows, F.lit("app")), "url") == ["http://app", "u1", "u1", "own"]


def channel(at, name):
    return (DAY + at, "openChannel", {"eventBody": '{"openChannelName":"%s"}' % name})


def push(at, text):
    return (DAY + at, "jPush", {"eventBody": '{"pushContent":"%s"}' % text})


def urls(spark, *rows):
    out = context.attribute_campaign(events(spark, *rows)).where("eventName = 'pageview'")
    return column(out, "url")


def test_a_campaign_is_used_once(spark):
    assert urls(spark, view(0, "u"), channel(1, "c1"), view(2, "u"), view(3, "u")) == [
        "u", "u?utm_campaign=c1", "u"]


def test_a_url_that_the_client_tagged_is_not_tagged_again(spark):
    assert urls(spark, channel(1, "c1"), view(2, "u?utm_campaign=c1"), view(3, "u")) == ["u?utm_campaign=c1", "u"]


def test_the_last_channel_wins(spark):
    assert urls(spark, channel(1, "c1"), channel(2, "c2"), view(3, "u?a=1")) == ["u?a=1&utm_campaign=c2"]


def test_push_content_goes_out_with_the_push(spark):
    assert urls(spark, push(1, "hello"), view(2, "u"), view(3, "u")) == [
        "u?utm_campaign=trackJPush&pushContent=hello", "u"]
    assert urls(spark, push(1, ""), view(2, "u")) == ["u?utm_campaign=trackJPush"]


def test_push_content_stays_for_a_later_campaign(spark):
    # the empty channel replaces the campaign of the push, but not its content
    assert urls(
        spark, push(1, "old"), channel(2, ""), view(3, "u"), channel(4, "c1"), view(5, "u"), channel(6, "c2"), view(7, "u"),
    ) == ["u", "u?utm_campaign=c1&pushContent=old", "u?utm_campaign=c2"]


def test_pages_of_web_views_do_not_use_the_campaign(spark):
    assert urls(spark, channel(1, "c1"), view(2, "h5", bridgeInfo="{}"), view(3, "u")) == [
        "h5", "u?utm_campaign=c1"]


def login(at, user):
    return (DAY + at, "login", {"userId": user})


def test_user_is_carried_until_after_the_logout(spark):
    rows = events(
        spark, (DAY, "a"), login(1, "u1"), (DAY + 2, "a"), (DAY + 3, "logout"), (DAY + 4, "a"), login(5, "u2"), (DAY + 6, "a"),
    )
    assert column(identity.carry_user(rows), "userId") == [None, "u1", "u1", "u1", None, "u2", "u2"]
    kept = identity.carry_user(rows, clears=F.lit(False))
    assert column(kept, "userId") == [None, "u1", "u1", "u1", "u1", "u2", "u2"]


def test_backfill_keeps_to_the_horizon(spark):
    rows = events(spark, (DAY, "a"), (DAY + 1, "a"), login(20_001, "u1"), (DAY + 20_002, "a"))
    assert column(identity.backfill_user(rows), "userId") == [None, "u1", "u1", None]


def test_anonymous_events_after_a_logout_get_the_next_user_within_the_horizon(spark):
    rows = events(spark, login(0, "u1"), (DAY + 1, "logout"), (DAY + 2, "a"), login(3, "u2"))
    assert column(identity.resolve_user(rows), "userId") == ["u1", "u1", "u2", "u2"]


def test_user_property_ends_with_any_logout(spark):
    rows = events(
        spark, (DAY, "a", {"userProperty": '{"v":1}'}), (DAY + 1, "a"), (DAY + 2, "logout"), (DAY + 3, "a"))
    assert column(identity.carry_user_property(rows), "userProperty") == ['{"v":1}'] * 3 + [None]


def test_registration_is_never_reset(spark):
    rows = events(
        spark, login(0, "u"), (DAY + 1, "initJPush", {"eventBody": '{"pushManager":{"registrationID":"r1"}}'}),
        (DAY + 2, "register"), (DAY + 3, "logout"), (DAY + 4, "initJPush"), login(5, "u"), (DAY + 6, "a"))
    assert column(identity.carry_registration(rows), "registrationID") == [
        None, None, "r1", None, None, "r1", None]


def test_the_login_of_an_embedded_page_sets_what_it_names(spark):
    from footfall.operators.identity import carry_user

    bridge = {"bridgeInfo": "{}"}
    rows = events(
        spark, (DAY, "login", {"userId": "u"}), (DAY + 1, "a"), (DAY + 2, "login", bridge), (DAY + 3, "b"),
        (DAY + 4, "login", {**bridge, "userId": "w"}), (DAY + 5, "c"), (DAY + 6, "login"), (DAY + 7, "d"))
    assert column(carry_user(rows), "userId") == ["u", "u", None, None, "w", "w", "w", "w"]
