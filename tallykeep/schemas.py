"""Schemas of the metadata and log tables, as readers and ``createDataFrame`` take them."""

RULE_ASSIGNMENT = "job_id bigint, validation_type string, rule_id int"

RULE_EXECUTION_LOG = (
    "job_id bigint, rule_id int, source_value string, target_value string, "
    "source_value_type string, target_value_type string, source_name string, target_name string, "
    "rule_run_status string, created_time timestamp, created_by string, object_name string"
)

AUDIT_LOG = (
    "product_name string, file_name string, file_size bigint, file_arrival_time timestamp, "
    "file_count bigint, file_balance_amount decimal(38,2)"
)

FILE_METADATA = (
    "file_id bigint, job_id bigint, file_name string, balance_amount_column string, "
    "min_value bigint, max_value bigint, file_size bigint, "
    "file_expected_time timestamp, file_buffer_time int"
)

JOB_METADATA = "job_id bigint, batch_id string"

CHECKSUM_REGISTRY = (
    "file_name string, checksum_value string, created_time timestamp, created_by string"
)

BATCH_RUNS = (
    "execution_run_id string, batch_id string, source_id string, "
    "batch_start_time timestamp, batch_end_time timestamp, status string"
)

JOB_RUNS = (
    "job_run_id string, execution_run_id string, job_id bigint, job_name string, "
    "source_system string, source_path string, target_system string, target_path string, "
    "source_count bigint, target_count bigint, reject_count bigint, "
    "job_start_time timestamp, job_end_time timestamp, duration_in_seconds bigint, status string"
)

FILE_RUNS = (
    "file_run_id string, execution_run_id string, job_run_id string, file_id bigint, "
    "load_start_time timestamp, source_count bigint, target_count bigint, "
    "load_end_time timestamp, duration_in_seconds bigint, status string"
)

ERROR_LOG = (
    "execution_run_id string, error_code string, error_id string, error_message string, "
    "error_type string, object_name string, object_run_id string, created_date timestamp"
)

VALIDATION_LOG = "job_id bigint, seq int, level string, line string"

# Job-argument columns as they appear in the argument files (fixed values). The credential
# columns of those files are left out: sessions get their credentials from the cluster.
JOB_ARGUMENT_COLUMNS = {
    "JobId": ("job_id", "bigint"),
    "ObjectPath": ("object_path", "string"),
    "ObjectName": ("object_name", "string"),
    "BalanceAmountColumn": ("balance_amount_column", "string"),
    "ObjectType": ("object_type", "string"),
    "ObjectPath_PostProcessing": ("object_path_post", "string"),
    "FileType": ("file_type", "string"),
    "log_path": ("log_path", "string"),
    "Config_file_url": ("config_file_url", "string"),
    "Metadata_place": ("metadata_place", "string"),
    "Metadata_column": ("metadata_column", "int"),
    "Manifest_file_url": ("manifest_file_url", "string"),
    "HeadCount_value_start_index": ("count_start", "int"),
    "HeadCount_value_end_index": ("count_end", "int"),
    "BalanceAmount_value_start_index": ("balance_start", "int"),
    "BalanceAmount_value_end_index": ("balance_end", "int"),
    "Sql_query_balanceamount": ("balance_query", "string"),
    "Sql_query_recordcount": ("count_query", "string"),
    "Post_Metadata_place": ("post_metadata_place", "string"),
    "Post_FileType": ("post_file_type", "string"),
}
