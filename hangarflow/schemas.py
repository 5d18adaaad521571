"""Explicit schemas of the datasets, for sources that carry none of their own."""

from pyspark.sql import types as T


READINGS = (
    "id bigint, aircraft_id string, sensor_id string, sensor_type string, measurement_timestamp timestamp, "
    "measurement_value decimal(12,4), measurement_unit string, raw_data_json string, "
    "ingestion_timestamp timestamp, source_file string, data_quality_flag string"
)
DAILY = (
    "aircraft_id string, date date, cycle int, temperature double, vibration double, pressure double, "
    "rpm double, altitude double, ambient_temp double, flight_hours double, failed int, "
    "days_to_failure int, will_fail_7days int"
)
MAINTENANCE = (
    "id bigint, aircraft_id string, component_id string, maintenance_type string, maintenance_action string, "
    "failure_occurred boolean, failure_type string, failure_description string, scheduled_date timestamp, "
    "actual_start_date timestamp, actual_end_date timestamp, technician_id string, parts_used_json string, "
    "labor_hours decimal(6,2), cost_total decimal(10,2), notes string, ingestion_timestamp timestamp, "
    "source_system string"
)
MAINTENANCE_FILE = (
    "aircraft_id string, maintenance_date date, maintenance_type string, issue_detected string, "
    "downtime_hours double, cost_usd double, parts_replaced string"
)
INVENTORY = (
    "id bigint, part_number string, part_name string, warehouse_location string, quantity_on_hand int, "
    "quantity_reserved int, quantity_available int, reorder_point int, unit_cost decimal(10,2), "
    "supplier_id string, lead_time_days int, snapshot_date date, ingestion_timestamp timestamp, "
    "source_system string"
)
INVENTORY_FILE = (
    "date date, part_name string, stock_level int, reorder_point int, lead_time_days int, "
    "unit_cost_usd double, supplier string"
)
FLEET = (
    "id bigint, aircraft_id string, aircraft_type string, manufacturer string, model string, "
    "serial_number string, registration_number string, manufacture_date date, acquisition_date date, "
    "total_flight_hours decimal(10,2), total_flight_cycles int, operational_status string, "
    "base_location string, operator string, configuration_json string, ingestion_timestamp timestamp, "
    "last_updated timestamp"
)
FLEET_FILE = (
    "aircraft_id string, model string, manufacture_year int, total_flight_hours double, total_cycles int, "
    "location string, status string"
)
RUN_TO_FAILURE = ["engine_id", "cycle", "op_setting_1", "op_setting_2", "op_setting_3"] + [
    f"sensor_{i}" for i in range(1, 22)
]

# Columns a source must have before it is loaded (name -> declared type).
REQUIRED = {
    "sensor_data": {
        "aircraft_id": "string", "sensor_id": "string", "sensor_type": "string",
        "measurement_timestamp": "timestamp", "measurement_value": "double",
    },
    "maintenance_records": {
        "aircraft_id": "string", "maintenance_type": "string", "maintenance_action": "string",
        "actual_start_date": "timestamp",
    },
    "inventory_data": {"part_number": "string", "snapshot_date": "date", "quantity_on_hand": "int"},
    "aircraft_metadata": {"aircraft_id": "string", "aircraft_type": "string", "manufacturer": "string"},
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
