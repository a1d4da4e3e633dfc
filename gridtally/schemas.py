"""Declared schemas; no pipeline infers one."""

RAW_READING = (
    "meter_id string, household_id string, event_timestamp string, consumption_kwh double, "
    "stdorToU string, source_system string"
)

STANDARDIZED_READING = (
    "meter_id string, household_id string, event_timestamp timestamp_ntz, consumption_kwh double, "
    "stdor_to_u string, source_system string, processed_at timestamp_ntz, ingestion_run_id string, "
    "standardize_run_id string"
)

# Rejected and accepted rows keep one layout.
GOLD_READING = STANDARDIZED_READING

READING_FACT = (
    "source_household_id string, meter_id string, reading_timestamp timestamp_ntz, consumption_kwh double, "
    "stdor_to_u string, source_system string, ingestion_date timestamp_ntz, ingestion_run_id string, "
    "standardize_run_id string"
)

CHANGE_EVENT = (
    "source_system string, source_table string, operation string, source_primary_key string, "
    "event_timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz, schema_version string, payload string"
)

CHANGE_ERROR = "error string, raw string"

DEAD_LETTER = (
    "dlq_id string, source_system string, source_table string, original_payload string, error_category string, "
    "error_message string, processing_attempt_count int, failure_timestamp timestamp_ntz, status string"
)

RUN_MANIFEST = (
    "run_id string, dataset string, status string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "rows_extracted bigint, batches_written bigint, watermark_start string, watermark_end string, error string"
)
