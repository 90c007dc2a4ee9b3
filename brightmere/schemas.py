"""Fixed record layouts, looked up by name."""

from __future__ import annotations

from pyspark.sql.types import StructType

_POLYGON = "STRUCT<coordinates: ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>, type: STRING>"
_POINT = "STRUCT<coordinates: ARRAY<DOUBLE>, type: STRING>"
_LINEAGE = "load_id STRING, loaded_on TIMESTAMP"

# Column names, order and types of the landed, interim and warehouse layers.
LAYOUTS = {
    "in_parkingbay_schema": f"""
        the_geom {_POLYGON}, marker_id STRING, meter_id STRING, bay_id STRING NOT NULL,
        last_edit STRING, rd_seg_id STRING, rd_seg_dsc STRING""",
    "in_sensordata_schema": f"""
        bay_id STRING NOT NULL, st_marker_id STRING, status STRING, location {_POINT},
        lat STRING, lon STRING""",
    "interim_parkingbay_schema": f"""
        bay_id INT NOT NULL, last_edit TIMESTAMP, marker_id STRING, meter_id STRING,
        rd_seg_dsc STRING, rd_seg_id INT, the_geom {_POLYGON}, {_LINEAGE}""",
    "interim_sensor": f"""
        bay_id INT NOT NULL, st_marker_id STRING, lat FLOAT, lon FLOAT, location {_POINT},
        status STRING, {_LINEAGE}""",
    "dw_dim_parking_bay": f"""
        dim_parking_bay_id STRING NOT NULL, bay_id INT, marker_id STRING, meter_id STRING,
        rd_seg_dsc STRING, rd_seg_id STRING, {_LINEAGE}""",
    "dw_dim_location": f"dim_location_id STRING NOT NULL, lat FLOAT, lon FLOAT, {_LINEAGE}",
    "dw_dim_st_marker": f"dim_st_marker_id STRING NOT NULL, st_marker_id STRING, {_LINEAGE}",
    "dw_fact_parking": f"""
        dim_date_id STRING, dim_time_id INT, dim_parking_bay_id STRING, dim_location_id STRING,
        dim_st_marker_id STRING, status STRING, {_LINEAGE}""",
    "fs_taxi": """
        pickup_timestamp TIMESTAMP, hour_pickup INT, day_pickup INT, weekday_pickup INT,
        month_pickup INT, demand INT, borough_id INT""",
    "fs_weather": """
        time TIMESTAMP, hour INT, day INT, month INT, year INT, temperature_2m_c DOUBLE,
        precipitation_mm DOUBLE, cloudcover_percentage INT, windspeed_10m_km_per_hour DOUBLE,
        id INT""",
    "device_event": "deviceId INT, temperature INT, time STRING",
    "device_reading": "messageId INT, deviceId STRING, temperature DOUBLE, humidity DOUBLE",
    "telemetry": "deviceId STRING, telemetryData MAP<STRING, STRING>, deviceTime TIMESTAMP",
    "permissions": """
        datalakeProperties ARRAY<STRUCT<year: STRING, month: STRING,
        aclPermissions: ARRAY<STRUCT<type: STRING, groups: ARRAY<STRING>>>,
        created: STRING, lastUpdatedSourceSystem: STRING, lastUpdatedDatalake: STRING>>""",
    "indicator": """
        indicator STRUCT<id: STRING, value: STRING>, country STRUCT<id: STRING, value: STRING>,
        countryiso3code STRING, date STRING, value BIGINT, unit STRING, obs_status STRING,
        decimal INT""",
}


def get_schema(name: str) -> StructType:
    """The layout called ``name``; an unknown name raises ``KeyError``."""
    return StructType.fromDDL(LAYOUTS[name])
