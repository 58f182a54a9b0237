"""Column names and values that the input and output files fix."""

# --- fixed values: header of the stop-event files -> column name ---------------
SERVICE_COLUMNS = {
    "Service:RDT-ID": "service_rdt_id",
    "Service:Date": "service_date",
    "Service:Type": "service_type",
    "Service:Company": "service_company",
    "Service:Train number": "service_train_number",
    "Service:Completely cancelled": "service_completely_cancelled",
    "Service:Partly cancelled": "service_partly_cancelled",
    "Service:Maximum delay": "service_maximum_delay",
    "Stop:RDT-ID": "stop_rdt_id",
    "Stop:Station code": "stop_station_code",
    "Stop:Station name": "stop_station_name",
    "Stop:Arrival time": "stop_arrival_time",
    "Stop:Arrival delay": "stop_arrival_delay",
    "Stop:Arrival cancelled": "stop_arrival_cancelled",
    "Stop:Departure time": "stop_departure_time",
    "Stop:Departure delay": "stop_departure_delay",
    "Stop:Departure cancelled": "stop_departure_cancelled",
    "Stop:Platform change": "stop_platform_change",
    "Stop:Planned platform": "stop_planned_platform",
    "Stop:Actual platform": "stop_actual_platform",
}

SERVICE_INTS = ["service_train_number", "service_maximum_delay"]
SERVICE_DOUBLES = ["stop_arrival_delay", "stop_departure_delay"]
SERVICE_FLAGS = [
    "service_completely_cancelled",
    "service_partly_cancelled",
    "stop_arrival_cancelled",
    "stop_departure_cancelled",
    "stop_platform_change",
]

# --- fixed values: station and disruption files ---------------------------------
STATION_COLUMNS = {
    "code": "station_code",
    "country": "station_country",
    "geo_lat": "station_geo_lat",
    "geo_lng": "station_geo_lng",
}

DISRUPTION_COLUMNS = {
    "rdt_station_codes": "disruption_station_code",
    "cause_en": "disruption_cause_en",
    "statistical_cause_en": "disruption_statistical_cause_en",
    "cause_group": "disruption_cause_group",
    "start_time": "disruption_start_time",
    "end_time": "disruption_end_time",
}

# --- fixed values: hourly weather columns, in output order ----------------------
WEATHER_KEYS = ["station", "time", "lat", "lon", "stationname"]
WEATHER_MEASURES = [
    "T",     # air temperature, 0.1 degree C
    "T10N",  # lowest temperature at 10 cm, 0.1 degree C
    "TD",    # dew point, 0.1 degree C
    "U",     # relative humidity, %
    "RH",    # relative humidity, %
    "DR",    # precipitation duration, 0.1 h
    "DD",    # wind direction, degrees
    "FF",    # mean wind speed, 0.1 m/s
    "FH",    # hourly mean wind speed, 0.1 m/s
    "FX",    # highest gust, 0.1 m/s
    "VV",    # visibility code
    "N",     # cloud cover, octants
    "WW",    # present weather code
    "P",     # air pressure, 0.1 hPa
    "SQ",    # sunshine duration, 0.1 h
    "Q",     # global radiation, J/cm2
]

# A stop counts as "with weather" when any of these is present.
WEATHER_EVIDENCE = ["T", "FF", "DR", "VV", "P", "U", "DD", "FX", "N"]

# --- fixed values: hourly report ------------------------------------------------
REPORT_COLUMNS = [
    "season",
    "service_date",
    "hour",
    "hour_share_of_day",
    "pct_completely_cancelled",
    "pct_partly_cancelled",
    "pct_delayed",
    "pct_on_time",
    "pct_short_delay",
    "pct_long_delay",
    "avg_avg_delay_all_services",
    "avg_avg_delay_delays_only",
    "services_in_hour",
    "services_in_day",
    "completely_cancelled",
    "partly_cancelled",
    "delayed_count",
    "on_time_count",
    "short_delay_count",
    "long_delay_count",
    "holiday_name",
    "holiday_category",
]

CALENDAR_COLUMNS = ["event_date", "name", "category"]
