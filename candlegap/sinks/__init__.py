from candlegap.sinks.files import (
    JSON_TIMESTAMP_FORMAT,
    replace_pairs,
    replace_partitions,
    with_pair,
    write_layer,
    write_raw_json,
)
from candlegap.sinks.paths import scratch_path, shared_root

__all__ = ["JSON_TIMESTAMP_FORMAT", "replace_pairs", "replace_partitions", "scratch_path",
           "shared_root", "with_pair", "write_layer", "write_raw_json"]
