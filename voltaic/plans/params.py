"""Fixed parameters of the registered queries over the test tables.

``events`` stands in for readings of seven vehicles (6-hour windows, valid
band 5..150, risk above 60); ``lineitem`` for 1,000 suppliers with daily
readings of all seven signals (30-day windows). See FIXTURES.md.
"""
EV_WINDOW = "6 hours"
EV_BAND = (5.0, 150.0)
EV_RISK = 60.0
LI_WINDOW = "30 days"
BATTERY_CODES = [900, 1200, 1290, 1293, 1294, 1295]
WIDE_CODES = [4, 15, 56, 900, 1200, 1208, 1209]
SLICE_VEHICLE = "V3"
SLICE_START = "2024-01-05"
SLICE_END = "2024-01-10"
EVAL_THRESHOLD = 0.70
#: A previous stream window that started longer ago than this counts as none.
EV_STATE_TTL = "12 hours"
#: Look-ahead by time: two windows or a gap of them.
EV_HORIZON = "12 hours"
