"""The feature lists of the modelling runs. The key tuples and widths are fixed values."""

from __future__ import annotations

from clickfeat.plans.features import (
    count, delta, distinct, first_place, gap, last_day_ratio, last_place, mean_gap, ratio, sentinel_gap, size, span,
    statistic, two_level,
)

# ---- the wide training table ----------------------------------------------------------------------------------------

COUNTS = [
    size("channel"),
    size("app"),
    size("channel", "app"),
    size("device", "os"),
    size("device", "os", "hour"),
    size("device", "os", "15min"),
    size("ip"),
    size("ip", "day", "hour"),
    size("ip", "day", "15min"),
    size("ip", "day", "3min"),
    size("ip", "app"),
    size("ip", "app", "os"),
    size("ip", "app", "day", "hour"),
    size("ip", "device", "os", "app", "day", "15min"),
    size("ip", "device", "os", "app", "channel"),
]
DISTINCT = [
    distinct("ip", "channel"),
    distinct("channel", "app"),
    distinct("ip", "day", "hour"),
    distinct("ip", "day", "15min"),
    distinct("ip", "day", "3min"),
    distinct("ip", "day"),
    distinct("day", "ip"),
    distinct("ip", "app"),
    distinct("ip", "app", "os"),
    distinct("ip", "device"),
    distinct("ip", "device", "os", "app"),
    distinct("ip", "device", "os", "channel"),
    distinct("ip", "day", "hour", by=("ip",)),
    distinct("ip", "day", "15min", by=("ip",)),
    distinct("ip", "day", "3min", by=("ip",)),
    distinct("ip", "channel", "os", by=("ip",)),
]
STATISTICS = [
    statistic("mean", "hour", "ip", "day", "channel"),
    statistic("var", "hour", "ip", "app", "os"),
    statistic("mean", "15min", "ip", "device", "day"),
    statistic("mean", "3min", "ip", "device", "day"),
]
TWO_LEVEL = [
    two_level("mean", "ip", "device", "app"),
    two_level("mean", "channel", "device", "app"),
    two_level("mean", "device", "os", "app", "channel"),
    two_level("mean", "os", "ip"),
    two_level("var", "ip", "app", "channel", by=("app", "channel")),
    two_level("mean", "ip", "device", "app", "channel", by=("app", "channel")),
]
PLACES = [first_place("ip", "app", "device", "os"), last_place("ip"), last_place("ip", "hour")]
GAPS = [
    gap("next", "ip", "app", "device"),
    gap("next", "ip", "device", "os", "app"),
    sentinel_gap("ip", "device", "os", "app"),
    gap("last", "ip", "app", "os"),
    gap("last", "ip", "device", "os", "app"),
]
SPANS = [span("ip", "day"), span("ip", "device"), span("ip", "os", "device")]
MEAN_GAPS = [mean_gap("ip"), mean_gap("ip", "device"), mean_gap("ip", "os", "device"), mean_gap("os", "device")]
LAST_DAY = [last_day_ratio("ip"), last_day_ratio("ip", "device"), last_day_ratio("channel")]
WIDE = [*COUNTS, *DISTINCT, *STATISTICS, *TWO_LEVEL, *PLACES, *GAPS, *SPANS, *MEAN_GAPS, *LAST_DAY]
# Added once the wide table stands; the first one reads a column of it.
DERIVED = [
    statistic("median", "ip_count", "app", name="ip_count_app_median"),
    ratio("app", of=("app", "channel"), name="ratio1"),
]

# ---- counts over train and test together ----------------------------------------------------------------------------

COUNTS_ALL_ROWS = [
    size("ip"),
    size("ip", "app"),
    size("ip", "app", "os"),
    size("ip", "device"),
    size("app", "channel"),
    size("ip", "day", "hour"),
    size("ip", "os", "day", "hour"),
    size("ip", "app", "day", "hour"),
    size("ip", "device", "day", "hour"),
    size("day", "hour", "app"),
    distinct("ip", "channel", name="ip_channel_unique"),
]

# ---- the second training table --------------------------------------------------------------------------------------

SELECTED = [
    distinct("ip", "channel", name="X0"),
    first_place("ip", "device", "os", name="X1"),
    distinct("ip", "day", "hour", name="X2"),
    distinct("ip", "app", name="X3"),
    distinct("ip", "app", "os", name="X4"),
    distinct("ip", "device", name="X5"),
    distinct("app", "channel", name="X6"),
    first_place("ip", name="X7"),
    distinct("ip", "device", "os", "app", name="X8"),
    sentinel_gap("ip", "app", "device", "os", name="nextClick"),
    count("channel", "ip", "day", "hour", name="ip_tcount"),
    count("channel", "ip", "app", name="ip_app_count"),
    count("channel", "ip", "app", "os", name="ip_app_os_count"),
    statistic("var", "hour", "ip", "day", "channel", name="ip_tchan_count"),
    statistic("var", "hour", "ip", "app", "os", name="ip_app_os_var"),
    statistic("var", "day", "ip", "app", "channel", name="ip_app_channel_var_day"),
    statistic("mean", "hour", "ip", "app", "channel", name="ip_app_channel_mean_hour"),
]
DELTAS = [
    delta("ip"),
    delta("app"),
    delta("channel"),
    delta("ip", "app"),
    delta("ip", "channel"),
    delta("app", "channel"),
    delta("ip", "app", "channel"),
]
# The gap of this key is read one row later in file order.
SHIFTED_DELTA = ("ip", "os", "app")
# The key of each letter.
RUNNING_KEYS = {
    "a": ("ip",),
    "b": ("device",),
    "c": ("os",),
    "d": ("app",),
    "e": ("channel",),
    "f": ("ip", "app"),
    "g": ("channel", "app"),
    "h": ("ip", "channel"),
    "i": ("ip", "channel", "app"),
    "j": ("device", "channel", "app"),
    "k": ("ip", "app", "day"),
}
RUNNING = [
    made(*keys, name=f"{prefix}_{tag}")
    for tag, keys in RUNNING_KEYS.items()
    for prefix, made in (("prev", first_place), ("future", last_place))
]
HISTORY_KEYS = [
    ("ip",),
    ("device",),
    ("os",),
    ("app",),
    ("channel",),
    ("ip", "app"),
    ("channel", "app"),
    ("ip", "channel"),
]

# ---- statistics of the second schema --------------------------------------------------------------------------------

# The score columns with the short names their statistics carry, and the statistics outside the pattern.
SCORES = {
    "shop_review_positive_rate": "review",
    "shop_score_service": "service",
    "shop_score_delivery": "delivery",
    "shop_score_description": "description",
}
IMPRESSION_STATISTICS = [
    (("shop_id",), "instance_id", "count", "shop_cnt"),
    (("shop_review_num_level",), "instance_id", "count", "shop_review_num_level_cnt"),
    (("shop_star_level",), "instance_id", "count", "shop_star_level_cnt"),
    (("user_id", "item_id"), "shop_review_positive_rate", "mean", "shop_review_positive_mean"),
    (("user_id", "item_id"), "shop_score_service", "mean", "shop_score_service_mean"),
    (("context_page_id", "item_id"), "item_sales_level", "mean", "item_sales_mean"),
    (("context_page_id", "item_id"), "shop_star_level", "mean", "shop_star_mean"),
]
# The median of the description score by shop is taken per shop and item.
IMPRESSION_STATISTICS += [
    (("shop_id", "item_id") if (of, how, short) == ("shop", "median", "description") else (f"{of}_id",), value, how, f"{of}_{short}_{how}")
    for of, hows in (("shop", ("median", "mean")), ("item", ("median", "mean")), ("user", ("mean",)))
    for how in hows
    for value, short in SCORES.items()
]

# ---- counts in a time range -----------------------------------------------------------------------------------------

RECENT_SECONDS = (180, 600, 900, 1800, 3600)
ROLLING_MINUTES = (2, 15, 30, 60)
# Fixed values, in seconds.
USER_ITEM_SECONDS = (300, 120)
USER_FIELD_SECONDS = (120, 900)


def recent_widths(seconds=RECENT_SECONDS) -> dict[str, int]:
    return {f"recent_click_cnt_{s}": s for s in seconds}


def rolling_widths(keys, label: str = "last_time_click", minutes=ROLLING_MINUTES) -> dict[str, int]:
    return {f"{'_'.join(keys)}_{label}_{m}min": 60 * m for m in minutes}
