from tallykeep.sinks.tables import (
    VersionConflict, append_jdbc, append_once, append_registry, latest_snapshot, read_snapshot, update_open_runs, vacuum_snapshots,
    write_snapshot,
)

__all__ = [
    "VersionConflict", "append_jdbc", "append_once", "append_registry", "latest_snapshot", "read_snapshot", "update_open_runs",
    "vacuum_snapshots", "write_snapshot",
]
