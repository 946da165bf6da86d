from oddlens.sources.stages import StageStore, stage
from oddlens.sources.tables import (
    load_metadata,
    load_table,
    read_trial_log,
    restore_split,
    write_metric_csv,
    write_partitioned,
)

__all__ = [
    "StageStore",
    "load_metadata",
    "load_table",
    "read_trial_log",
    "restore_split",
    "stage",
    "write_metric_csv",
    "write_partitioned",
]
