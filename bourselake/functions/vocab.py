"""Vocabularies shared by all operators."""

# Schemas stored one partition per day.
TICK_SCHEMAS = ("trades", "mbp-1", "mbp-10", "mbo", "tbbo", "bbo-1s", "bbo-1m")

# Bar schemas from coarse to fine, for inventory listings.
BAR_SCHEMA_RANK = {"ohlcv-1d": 0, "ohlcv-1h": 1, "ohlcv-1m": 2, "ohlcv-1s": 3}
OTHER_SCHEMA_RANK = 99

# Datasets that do not follow the default calendar.
FUTURES_CALENDAR = "CMES"
DEFAULT_CALENDAR = "XNYS"
DATASET_CALENDAR = {
    "GLBX.MDP3": "CMES",
    "IFEU.IMPACT": "IEPA",
    "IFLL.IMPACT": "IEPA",
    "IFUS.IMPACT": "IEPA",
    "NDEX.IMPACT": "IEPA",
}

# Contract month letters, January to December.
MONTH_LETTERS = "FGHJKMNQUVXZ"

# Product roots by expiration rule.
EQUITY_INDEX_ROOTS = (
    "EMD", "ES", "M2K", "MES", "MNQ", "MYM", "NIY", "NKD", "NQ", "RTY", "YM",
)
TREASURY_ROOTS = ("UB", "ZB", "ZF", "ZN", "ZT")
METAL_ROOTS = ("GC", "HG", "PA", "PL", "SI")

ROOTS_BY_RULE = {
    "third_friday": EQUITY_INDEX_ROOTS,
    "treasury": TREASURY_ROOTS,
    "metals": METAL_ROOTS,
}
SUPPORTED_ROOTS = tuple(sorted(r for roots in ROOTS_BY_RULE.values() for r in roots))

DEFAULT_ROLLOVER_DAYS = 14
