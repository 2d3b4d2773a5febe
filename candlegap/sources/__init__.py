from candlegap.sources.documents import (
    DOCUMENT_SCHEMA,
    bronze_to_documents,
    classify_documents,
    flatten_documents,
    read_documents,
)
from candlegap.sources.events import (
    bars_to_bronze,
    event_bars,
    events_as_bronze_copies,
    events_to_bronze,
    load_events,
)
from candlegap.sources.files import scan_layer, scan_raw_json

__all__ = [
    "DOCUMENT_SCHEMA", "bars_to_bronze", "bronze_to_documents", "classify_documents",
    "event_bars", "events_as_bronze_copies", "events_to_bronze", "flatten_documents",
    "load_events", "read_documents", "scan_layer", "scan_raw_json",
]
