"""Declared schemas of the source tables.

Fixed values: table paths, column names and types of the data set.
``blank`` lists the text columns in which an empty string stands for a missing
value. Only these are rewritten on read; a filter on any other column reaches
the Parquet scan unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    path: str
    fmt: str
    ddl: str
    keys: tuple[str, ...] = ()
    blank: tuple[str, ...] = ()


def _t(path, fmt, ddl, keys, blank=()):
    return TableSpec(path, fmt, ddl, tuple(keys.split()), tuple(blank))


TABLES: dict[str, TableSpec] = {
    # one Parquet file
    "ticket_sales": _t(
        "data/parquet/ticket_sales", "parquet",
        "ticket_sale_id string, ticket_id string, parent_ticket_id string, attendee_id string, purchase_ts string, "
        "ticket_type_id string, sales_channel string, amount_jpy bigint, discount_jpy bigint, payment_status string, "
        "preferred_stage_id string, wishlist_artist_id string",
        "ticket_sale_id", ["parent_ticket_id", "preferred_stage_id", "wishlist_artist_id"]),
    "performance_schedule": _t(
        "data/parquet/performances/performance_schedule.parquet", "parquet",
        "performance_id string, festival_date string, stage_id string, artist_id string, artist_name string, "
        "genre string, planned_start_ts string, planned_end_ts string, planned_duration_minutes bigint, "
        "slot_index bigint, headline_flag bigint",
        "performance_id"),
    "performance_actual": _t(
        "data/parquet/performances/performance_actual.parquet", "parquet",
        "performance_id string, festival_date string, stage_id string, actual_start_ts string, actual_end_ts string, "
        "delay_minutes bigint, status string, incident_id string, cancellation_reason string",
        "performance_id", ["actual_start_ts", "actual_end_ts", "incident_id", "cancellation_reason"]),
    "equipment_maintenance": _t(
        "data/parquet/equipment_maintenance", "parquet",
        "maintenance_id string, equipment_id string, scheduled_date string, completed_date string, "
        "maintenance_type string, status string, vendor_id string, notes string",
        "maintenance_id", ["completed_date", "notes"]),
    "incidents": _t(
        "data/parquet/incidents", "parquet",
        "incident_id string, festival_date string, location_id string, category string, severity string, "
        "start_ts string, end_ts string, title string, impacted_people bigint, related_equipment_id string, "
        "status string, document_id string, summary string",
        "incident_id", ["related_equipment_id", "document_id"]),
    "refund_requests": _t(
        "data/parquet/refund_requests", "parquet",
        "request_id string, ticket_id string, parent_ticket_id string, attendee_id string, request_ts string, "
        "reason_code string, requested_amount_jpy bigint, customer_comment string, review_status string",
        "request_id", ["parent_ticket_id", "customer_comment"]),
    # one Parquet directory per day (year=/month=/day=)
    "admission_logs": _t(
        "data/parquet/admission_logs", "parquet",
        "scan_id string, event_ts string, festival_date string, gate_id string, ticket_id string, "
        "attendee_id string, result_code string, scan_duration_ms bigint, device_id string, "
        "firmware_version string, queue_estimate_minutes bigint",
        "scan_id"),
    "equipment_sensor_logs": _t(
        "data/parquet/equipment_sensor_logs", "parquet",
        "sensor_event_id string, event_ts string, festival_date string, stage_id string, equipment_id string, "
        "metric_name string, metric_value double, unit string, status string",
        "sensor_event_id"),
    "merchandise_sales": _t(
        "data/parquet/merchandise_sales", "parquet",
        "sale_id string, sale_ts string, festival_date string, booth_id string, product_id string, "
        "artist_id string, quantity bigint, unit_price_jpy bigint, total_amount_jpy bigint, "
        "payment_method string, ticket_id string",
        "sale_id"),
    "inventory_snapshots": _t(
        "data/parquet/inventory_snapshots", "parquet",
        "snapshot_id string, snapshot_ts string, festival_date string, product_id string, initial_stock bigint, "
        "units_sold bigint, on_hand_units bigint, stock_status string",
        "snapshot_id"),
    "weather_observations": _t(
        "data/parquet/weather_observations", "parquet",
        "weather_event_id string, observed_ts string, festival_date string, station_id string, "
        "temperature_c double, humidity_pct double, wind_avg_mps double, wind_gust_mps double, "
        "rainfall_mm_15m double, lightning_distance_km double, weather_code string",
        "weather_event_id"),
    # CSV with a header
    "stages": _t(
        "data/csv/master/stages.csv", "csv",
        "stage_id string, stage_name string, stage_type string, capacity bigint, location_zone string, "
        "network_zone string, weather_exposed_flag int",
        "stage_id"),
    "equipment_master": _t(
        "data/csv/master/equipment_master.csv", "csv",
        "equipment_id string, stage_id string, equipment_category string, model_name string, serial_number string, "
        "manufacturing_lot string, vendor_id string, firmware_version string, installed_date string, "
        "criticality string",
        "equipment_id"),
    "merch_products": _t(
        "data/csv/master/merchandise_products.csv", "csv",
        "product_id string, product_name string, artist_id string, category string, unit_price_jpy bigint, "
        "initial_stock_day1 bigint, initial_stock_day2 bigint, initial_stock_day3 bigint, vendor_id string, "
        "active_flag int",
        "product_id"),
    "merch_inventory_plan": _t(
        "data/csv/transactions/merch_inventory_plan.csv", "csv",
        "product_id string, festival_date string, baseline_forecast_units bigint, "
        "interest_adjusted_forecast_units bigint, planned_stock_units bigint, forecast_method_used string, "
        "planning_note string",
        "product_id festival_date"),
    "merch_interest_signals": _t(
        "data/csv/transactions/merch_interest_signals.csv", "csv",
        "signal_date string, product_id string, signal_source string, interest_score bigint, predicted_units bigint",
        "product_id signal_source"),
    "ticket_types": _t(
        "data/csv/master/ticket_types.csv", "csv",
        "ticket_type_id string, ticket_type_name string, valid_days string, base_price_jpy bigint, vip_flag int, "
        "addon_flag int",
        "ticket_type_id"),
    "document_catalog": _t(
        "metadata/document_catalog.csv", "csv",
        "document_id string, file_name string, document_type string, version string, effective_date string, "
        "purpose string",
        "document_id"),
    "document_pdf_mapping": _t(
        "metadata/document_pdf_mapping.csv", "csv", "document_id string, ascii_pdf_file_name string", "document_id"),
    "business_terms": _t(
        "metadata/business_terms.csv", "csv", "term string, synonyms string, definition string", "term"),
    "file_manifest": _t(
        "metadata/file_manifest.csv", "csv",
        "relative_path string, size_bytes bigint, sha256 string, object_storage_include int", "relative_path"),
    # JSON Lines
    "attendee_feedback": _t(
        "data/jsonl/attendee_feedback.jsonl", "json",
        "feedback_id string, submitted_ts string, festival_date string, attendee_id string, topic string, "
        "rating bigint, location_id string, sentiment string, comment string",
        "feedback_id"),
    "staff_action_logs": _t(
        "data/jsonl/staff_action_logs.jsonl", "json",
        "log_id string, event_ts string, team_id string, location_id string, incident_id string, "
        "action_type string, message string, operator_role string",
        "log_id", ["incident_id", "location_id"]),
}
