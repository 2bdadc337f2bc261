"""Fixed values. Results depend on them, so they are stated once, as plain text."""

# --- Fixed values: calendar -------------------------------------------------
WEEKDAYS_KR = ["일요일", "월요일", "화요일", "수요일", "목요일", "금요일", "토요일"]  # Sunday first
HOURS_PER_DAY = 24

# --- Fixed values: station dimension ----------------------------------------
CITY = "서울"
LINE_SUFFIX = "호선"
SUBWAY_LINES = ["1호선", "2호선", "3호선", "4호선", "5호선", "6호선", "7호선", "8호선"]
BIKE, BUS, SUBWAY = "BIKE", "BUS", "SUBWAY"

# --- Fixed values: surrogate keys -------------------------------------------
KEY_SEPARATOR = "-"
KEY_NULL_MARKER = "_dbt_utils_surrogate_key_null_"

# --- Fixed values: landing --------------------------------------------------
PAGE_ROWS = 1000
CHUNK_ROWS = 1_000_000
BIKE_USAGE_SERVICE = "cycleRentUseTimeInfo"
BIKE_STATION_SERVICE = "stationInfo"
BUS_STOP_SERVICE = "busStopLocationXyInfo"

# --- Fixed values: characters removed by a full whitespace trim --------------
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
