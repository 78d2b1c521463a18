from footfall.functions.text import (  # noqa: F401
    blank_to_null, escape_value, hash16, json_object, money, money_text,
    unescape_value,
)
from footfall.functions.clock import (  # noqa: F401
    day_number, from_utc_text, local_millis, utc_text,
)
