from oreflow.sinks.tables import (
    append_rows,
    batch_writer,
    drop_partitions,
    free_unused,
    insert_rows,
    partitions,
    register,
    replace_partitions,
    table_exists,
    write_snapshot,
)

__all__ = [
    "append_rows", "batch_writer", "drop_partitions", "free_unused", "insert_rows", "partitions", "register",
    "replace_partitions", "table_exists", "write_snapshot",
]
