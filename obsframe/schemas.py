"""Column names and types of every table and message the engine reads or writes."""

from pyspark.sql import types as T

# The weather variables by their public API names.
CASUAL_METRICS = [
    "temperature_2m", "relative_humidity_2m", "dew_point_2m", "apparent_temperature",
    "precipitation_probability", "precipitation", "rain", "showers", "snowfall", "snow_depth",
    "cloud_cover", "visibility", "wind_speed_10m", "wind_direction_10m", "wind_gusts_10m",
    "uv_index", "uv_index_clear_sky", "is_day", "sunshine_duration",
]
FULL_METRICS = [
    "temperature_2m", "relative_humidity_2m", "dew_point_2m", "apparent_temperature",
    "precipitation_probability", "precipitation", "rain", "showers", "snowfall", "snow_depth",
    "pressure_msl", "surface_pressure", "cloud_cover", "cloud_cover_low", "cloud_cover_mid",
    "cloud_cover_high", "visibility", "evapotranspiration", "et0_fao_evapotranspiration",
    "vapour_pressure_deficit", "wind_speed_10m", "wind_speed_80m", "wind_speed_120m",
    "wind_speed_180m", "wind_direction_10m", "wind_direction_80m", "wind_direction_120m",
    "wind_direction_180m", "wind_gusts_10m", "temperature_80m", "temperature_120m",
    "temperature_180m", "soil_temperature_0cm", "soil_temperature_6cm", "soil_temperature_18cm",
    "soil_temperature_54cm", "soil_moisture_0_to_1cm", "soil_moisture_1_to_3cm",
    "soil_moisture_3_to_9cm", "soil_moisture_9_to_27cm", "soil_moisture_27_to_81cm",
    "uv_index", "uv_index_clear_sky", "is_day", "sunshine_duration",
]
DAILY_VARIABLES = [
    "temperature_2m_max", "temperature_2m_min", "apparent_temperature_max",
    "apparent_temperature_min", "sunrise", "sunset",
]
TIMEZONE = "Asia/Bangkok"
FORECAST_DAYS = 7
LOCATIONS_PER_REQUEST = 30
ROWS_PER_PAGE = 500
# End of fixed values.

PROFILES = {"casual": CASUAL_METRICS, "full": FULL_METRICS}
DAILY_TEMPERATURES = DAILY_VARIABLES[:4]
INTEGER_METRICS = {
    "relative_humidity_2m", "precipitation_probability", "cloud_cover", "wind_direction_10m", "is_day",
}


def struct(**fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_text, _int, _long, _double = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# What arrives: numbers that the source keeps as decimals come as text.
CURRENT_WIRE = struct(
    locationID=_text, time=_text, **{m: _int if m in INTEGER_METRICS else _text for m in CASUAL_METRICS}
)
DAILY_WIRE = struct(
    id=_int, locationID=_text, time=_text,
    temperature_2m_min=_text, temperature_2m_max=_text,
    apparent_temperature_min=_text, apparent_temperature_max=_text,
    sunrise=_text, sunset=_text, time_created=_text,
)
LOCATION_WIRE = struct(id=_int, Name=_text, Latitude=_text, Longitude=_text, Address=_text)

# Column order of the location file.
LOCATION_FILE = struct(Name=_text, Latitude=_double, Longitude=_double, Address=_text, id=_long)

# One message per location. Metrics are read as text and cast afterwards, so that one value that is no
# number costs that value and not its message.
MESSAGE = struct(
    id=_text,
    current=struct(time=_text, **{m: _text for m in CASUAL_METRICS}),
    daily=struct(time=T.ArrayType(_text), **{v: T.ArrayType(_text) for v in DAILY_VARIABLES}),
)

# Logical tables: name -> (kind, wire schema).
TABLES = {
    "current": ("current", CURRENT_WIRE),
    "current_2": ("current", CURRENT_WIRE),
    "daily": ("daily", DAILY_WIRE),
    "daily_2": ("daily", DAILY_WIRE),
    "location": ("location", LOCATION_WIRE),
}

# Stored tables.
_metric = T.DecimalType(5, 2)
_whole_number_metrics = {
    "visibility", "wind_direction_10m", "uv_index", "uv_index_clear_sky", "is_day", "sunshine_duration",
}
LOCATIONS_TABLE = struct(
    id=_int, Name=_text, Latitude=T.DecimalType(10, 8), Longitude=T.DecimalType(11, 8), Address=_text
)
CURRENT_TABLE = struct(
    locationID=_int, time=T.TimestampType(),
    **{m: _int if m in _whole_number_metrics else _metric for m in CASUAL_METRICS},
)
DAILY_TABLE = struct(
    **{m: _metric for m in DAILY_TEMPERATURES},
    sunrise=T.TimestampType(), sunset=T.TimestampType(), time=T.TimestampType(),
    locationID=_int, time_created=T.TimestampType(),
)
STORED = {"locations": LOCATIONS_TABLE, "current": CURRENT_TABLE, "daily": DAILY_TABLE}
