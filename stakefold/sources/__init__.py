from .readers import clean_header, clean_names, read_csv_clean, row_counts  # noqa: F401
from .sinks import (  # noqa: F401
    audit_columns,
    conform,
    drop_audit_columns,
    fixed_scale_text,
    fixed_width,
    read_run_table,
    write_fixed_width,
    write_run_catalog,
    write_run_partition,
)
from .stage import StageArea  # noqa: F401
from .tables import Tables  # noqa: F401
