"""Network-telemetry threat detection on Spark: detectors, indicator table
jobs and streaming wiring. The public entry points are re-exported here."""

from tidewatch.operators.detect import (
    Thresholds, alerts, alerts_one_scan, data_exfiltration, ioc_candidates, ioc_match, pair_activity, port_scan,
)
from tidewatch.operators.enrich import with_locality, with_service, with_status_message
from tidewatch.operators.iocs import clean_iocs, explode_raw, merge_iocs, new_iocs, prepared_keys, refresh_last_seen
from tidewatch.operators.prefixes import with_segment
from tidewatch.plans.ioc_refresh import run_ioc_refresh
from tidewatch.plans.landing import follow_landing
from tidewatch.sources.iocs import read_iocs, read_raw
from tidewatch.sources.logs import decode_logs, file_stream, kafka_stream, read_logs, with_event_time
from tidewatch.streaming.detection import detection_stream, read_documents, run_detection, start_documents, start_sink
from tidewatch.streaming.documents import document_table, start_upserts

__all__ = [
    "Thresholds", "alerts", "alerts_one_scan", "data_exfiltration", "ioc_candidates", "ioc_match", "pair_activity", "port_scan",
    "with_locality", "with_service", "with_status_message",
    "clean_iocs", "explode_raw", "merge_iocs", "new_iocs", "prepared_keys", "refresh_last_seen",
    "run_ioc_refresh", "follow_landing", "read_iocs", "read_raw", "with_segment",
    "decode_logs", "file_stream", "kafka_stream", "read_logs", "with_event_time",
    "detection_stream", "read_documents", "run_detection", "start_documents", "start_sink",
    "document_table", "start_upserts",
]
