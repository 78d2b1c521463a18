"""Column names, schemas and fixed wire values shared by all operators."""

from pyspark.sql import types as T

# A device is only unique inside its project and site.
DEVICE = ("projectId", "siteId", "deviceId")

# Rows of one device are ordered by time, then serial number. A missing serial
# number counts as 0; real ones start at 1, so ascending nulls-first is the same.
EVENT_ORDER = ("eventTime", "sn")

SERIAL = T.DecimalType(20, 0)  # unsigned 64 bit, too wide for BIGINT
SERIAL_MAX = 18446744073709551615
MONEY = T.DecimalType(18, 2)

_TYPES = {
    "seStartTime": T.LongType(),
    "eventTime": T.LongType(),
    "sn": SERIAL,
    "lat": T.DoubleType(),
    "lgt": T.DoubleType(),
}

# Parameter names of the current protocol.
EVENT_COLUMNS = (
    "projectId", "siteId", "deviceId", "sessionId", "seStartTime", "userId",
    "eventTime", "sn", "eventName", "eventBody", "url", "title", "referrer",
    "userProperty", "bridgeInfo", "customerVar", "uaName", "uaBuild", "uaMajor",
    "uaMinor", "uaRevision", "uaOs", "uaOsMajor", "uaOsMinor", "uaDevice",
    "resolution", "language", "netType", "lat", "lgt",
)

# Reserved parameter names that no column is kept for. They still
# end the value before them, and land in `extra`.
RESERVED_COLUMNS = (
    "channelId", "ip", "continentCode", "country", "region", "city", "newVisit",
)

# Parameters that have `?` and `&` escaped on the wire; the others are added
# after that step and travel as they are.
ESCAPED_COLUMNS = (
    "sessionId", "seStartTime", "eventName", "eventBody", "url", "title",
    "referrer", "bridgeInfo",
)

EVENT_SCHEMA = T.StructType(
    [T.StructField(name, _TYPES.get(name, T.StringType())) for name in EVENT_COLUMNS]
    + [T.StructField("extra", T.MapType(T.StringType(), T.StringType()))]
)

# Parameter names of the legacy protocol.
LEGACY_COLUMNS = (
    "idsite", "rec", "apiv", "res", "_id", "_idts", "_viewts", "_idvc",
    "new_visit", "uid", "deviceId", "cdt", "h", "m", "s", "r", "url", "title",
    "action_name", "search", "e_c", "e_a", "e_n", "e_v", "cvar", "_cvar",
    "idgoal", "revenue", "ec_id", "ec_st", "ec_tx", "ec_sh", "ec_dt", "ec_items",
    "send_image", "lat", "lgt",
)
# Legacy values that come out of escaped parameters, or out of an escaped body.
LEGACY_ESCAPED = ("url", "title", "action_name", "search", "e_a", "e_n", "cvar")
LEGACY_RESERVED = (
    "lang", "search_cat", "search_count", "link", "download", "urlref", "_rcn",
    "_rck", "c_n", "c_p", "c_t", "c_i",
)

# Event names with a body of their own. Any other name is custom.
PAGEVIEW = "pageview"
SEARCH = "search"
PRODUCT_PAGE = "productPage"
ADD_CART = "addCart"
ORDER = "order"
PAYMENT = "payment"
PRE_CHARGE = "preCharge"
REGISTER = "register"
LOGIN = "login"
LOGOUT = "logout"
CLICK = "click"
PUSH = "jPush"
PUSH_INIT = "initJPush"
OPEN_CHANNEL = "openChannel"

KNOWN_EVENTS = (
    PAGEVIEW, SEARCH, PRODUCT_PAGE, ADD_CART, ORDER, PAYMENT, PRE_CHARGE,
    REGISTER, LOGIN, LOGOUT, CLICK, PUSH, PUSH_INIT, OPEN_CHANNEL,
)

# Defaults of the collecting client.
SESSION_TIMEOUT_S = 1800
USER_HORIZON_S = 20
EVENTS_PER_REQUEST = 10
MAX_QUEUED_EVENTS = 500
PUSH_CAMPAIGN = "trackJPush"

# Custom variable slots of the legacy protocol.
DEVICE_INFO_SLOT = "1"
CUSTOM_DIMENSION_SLOT = "4"
SYSTEM_SLOT = "5"
SERIAL_LABEL = "Lifetime_seq"

# Screens that automatic page views skip.
SCREEN_DENYLIST = (
    "UIInputViewController",
    "UIInputWindowController",
    "UIApplicationRotationFollowingController",
    "UIAlertController",
    "UICompatibilityInputViewController",
    "_UIRemoteInputViewController",
    "UIApplicationRotationFollowingControllerNoTouches",
)
