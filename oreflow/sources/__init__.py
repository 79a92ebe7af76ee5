from oreflow.sources.json_files import peek_raw, raw_files, read_json_batch, split_rejects, with_extra_fields
from oreflow.sources.tables import read_location, read_status, table_at

__all__ = [
    "peek_raw", "raw_files", "read_json_batch", "read_location", "read_status", "split_rejects",
    "table_at", "with_extra_fields",
]
