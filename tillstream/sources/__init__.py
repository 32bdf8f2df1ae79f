from .files import csv_backfill, read_csv_columns, read_with_fallback, write_csv  # noqa: F401
from .tables import (  # noqa: F401
    drop_old_versions,
    merge_insert_only,
    merge_upsert,
    overwrite_table,
    read_optional,
    read_table,
    table_exists,
    write_counted,
)
from .topics import file_topic, kafka_topic  # noqa: F401
