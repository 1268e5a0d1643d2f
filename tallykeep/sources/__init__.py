from tallykeep.sources.files import (
    control_cells, manifest_control, read_control, read_listing, read_manifests, read_objects,
)
from tallykeep.sources.relational import query_options, read_query, read_table, table_options
from tallykeep.sources.settings import param_lookup, read_job_args, read_params

__all__ = [
    "control_cells", "manifest_control", "param_lookup", "query_options", "read_control",
    "read_job_args", "read_listing", "read_manifests", "read_objects", "read_params",
    "read_query", "read_table", "table_options",
]
