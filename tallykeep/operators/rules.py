"""The twelve validation rules.

A rule compares a source value with a target value of one object. Each is written once, as
expressions over a row of measures (one row per object), and is used both alone, by the
functions at the end of this module, and together with the others by the suite, which
evaluates all of them in one pass over the measures.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

PRE, POST = "Pre", "Post"
PASSED, FAILED, ON_TIME, DELAY, ERROR = "Passed", "Failed", "On Time", "Delay", "Error"

# Fixed values: (source name, target name) a rule writes into the log, by object type.
AUDIT_LABELS = {
    "File": ("Audit Table", "ADLS Raw Layer"),
    "NASFile": ("Audit Table", "NAS Drive"),
    "SQLTable": ("Audit Table", "Azure SQL Server"),
}
SIZE_LABELS = {
    "File": ("ADLS RAW Layer", "ADLS Curated Layer"),
    "NASFile": ("Fileshare File", "ADLS RAW Layer"),
    "SQLTable": ("SQL Table", "ADL RAW layer"),
}
CHECKSUM_LABELS = {
    "File": ("File CheckSum Table", "ADLS Raw Layer"),
    "NASFile": ("File CheckSum Table", "NAS Drive"),
    "SQLTable": ("File CheckSum Table", "Azure SQL Server"),
}
POST_LABELS = ("Audit Table", "ADLS")
EGRESS_LABELS = ("ADLS", "SQL Server")


# Title, word for passed, source value type and target value type of every rule.
TITLES = {
    0: ("Zero FileSize Validation", "Passed", "Source File", "Target File"),
    1: ("CountValidation", "passed", "Source Count", "Target Count"),
    2: ("BalanceAmountValidation", "passed", "Source Balance Amount", "Target Balance Amount"),
    3: ("ThresholdValidation", "passed", "Source Threshold Value", "Target Object Count"),
    4: ("FileNameValidation", "passed", "Object Name", "Object Name"),
    5: ("File Size Validation", "passed", "Source Object Size", "Target Object Size"),
    6: ("FileArrival_Validation", "passed", "Source Object Arrival Time", "Target Object Arrival Time"),
    7: ("Missing_FileCheck_Validation", "passed", "Source Object Arrival Time", "Target Expected Time"),
    8: ("CountValidation Post File Processing", "passed",
        "Source Count Post Object Processing", "Target Count Post Object Processing"),
    9: ("BalanceAmountValidation Post File Processing", "passed",
        "Source Balance Amount Post Object Processing", "Target Balance Amount Post Object Processing"),
    10: ("CountValidation for Egress", "passed",
         "Source Count for Egress Object", "Target Count for Egress Object"),
    11: ("Duplicate_File_Check_Validation", "Passed", "Source Check Sum", "Target Check Sum"),
}

# Texts inside source and target values.
LOW_BOUND, HIGH_BOUND = "MinValue = ", " and MaxValue = "
LATE_BOUND, EARLY_BOUND = "Postive_Buffer_Time = ", " and Negative_Buffer_Time = "
ARRIVED, NOT_ARRIVED = "File has arrived", "File has not arrived"
INTERVAL_FROM, INTERVAL_TO = " in the time interval from ", " to "
CHECKSUM = "Check_sum = "


@dataclass(frozen=True)
class Rule:
    """A rule as SQL expressions over the measures of an object.

    ``holds`` decides between the two ``words``; it is only read when all ``required``
    measures are there, otherwise the rule is in error. ``optional`` ones may be null.
    """

    rule_id: int
    stage: str
    labels: dict[str, tuple[str, str]] | tuple[str, str]
    required: tuple[str, ...]
    optional: tuple[str, ...]
    source: str
    target: str
    holds: str
    words: tuple[str, str] = (PASSED, FAILED)

    @property
    def passed_text(self) -> str:
        title, word, _, _ = TITLES[self.rule_id]
        return f"{title} {word}"

    @property
    def failed_text(self) -> str:
        return f"{TITLES[self.rule_id][0]} Failed"

    @property
    def status(self) -> str:
        held, not_held = self.words
        complete = " and ".join(f"{name} is not null" for name in self.required) or "true"
        return f"case when {complete} then if({self.holds}, '{held}', '{not_held}') else '{ERROR}' end"


ROWS, POST_ROWS, SIZE, MATCHES = (
    f"coalesce({name}, 0L)" for name in ("row_count", "post_row_count", "text_size", "match_count")
)
BALANCE, POST_BALANCE = "cast(balance as bigint)", "cast(post_balance as bigint)"

# Arrival, expected time and buffer bounds, as timestamps and as times of day.
BUFFER = "make_interval(0, 0, 0, 0, 0, 0, cast(buffer_minutes * 60 as decimal(18,6)))"
SEEN, DUE = "arrival_time", "expected_time"
EARLIEST, LATEST = f"(expected_time - {BUFFER})", f"(expected_time + {BUFFER})"
SEEN_CLOCK, DUE_CLOCK, EARLIEST_CLOCK, LATEST_CLOCK = (
    f"date_format({ts}, 'HH:mm:ss')" for ts in (SEEN, DUE, EARLIEST, LATEST)
)


def arrival_rule(by_clock: bool = True) -> Rule:
    """On time from the early buffer up to the expected time, both included."""
    holds = f"{SEEN} between {EARLIEST} and {DUE}"
    if by_clock:
        holds = f"{SEEN_CLOCK} between {EARLIEST_CLOCK} and {DUE_CLOCK}"
    return Rule(
        6, PRE, AUDIT_LABELS, (SEEN, DUE, "buffer_minutes"), (), SEEN_CLOCK,
        f"'{LATE_BOUND}' || {LATEST_CLOCK} || '{EARLY_BOUND}' || {EARLIEST_CLOCK}", holds, (ON_TIME, DELAY),
    )


def window_rule(by_clock: bool = True) -> Rule:
    """Arrived between the early and the late buffer, both left out."""
    inside = f"{EARLIEST} < {SEEN} and {SEEN} < {LATEST}"
    if by_clock:
        inside = f"{EARLIEST_CLOCK} < {SEEN_CLOCK} and {SEEN_CLOCK} < {LATEST_CLOCK}"
    return Rule(
        7, PRE, AUDIT_LABELS, (SEEN, DUE, "buffer_minutes"), (), SEEN_CLOCK,
        f"if({inside}, '{ARRIVED}', '{NOT_ARRIVED}') || '{INTERVAL_FROM}' || {EARLIEST_CLOCK} "
        f"|| '{INTERVAL_TO}' || {LATEST_CLOCK}",
        inside,
    )


RULES = (
    Rule(0, PRE, SIZE_LABELS, (), ("text_size",), SIZE, SIZE, f"{SIZE} <> 0"),
    Rule(1, PRE, AUDIT_LABELS, ("control_count",), ("row_count",),
         "control_count", ROWS, f"control_count = {ROWS}"),
    Rule(2, PRE, AUDIT_LABELS, ("control_balance", "balance", "metadata_name"), (),
         "control_balance", BALANCE, f"control_balance = {BALANCE}"),
    Rule(3, PRE, AUDIT_LABELS, ("min_value", "max_value"), ("row_count",),
         f"'{LOW_BOUND}' || min_value || '{HIGH_BOUND}' || max_value", ROWS,
         f"{ROWS} between min_value and max_value"),
    Rule(4, PRE, AUDIT_LABELS, (), ("match_count",), "object_name", "object_name", f"{MATCHES} > 0"),
    Rule(5, PRE, AUDIT_LABELS, ("audit_file_size", "expected_file_size"), (),
         "audit_file_size", "expected_file_size", "audit_file_size = expected_file_size"),
    arrival_rule(),
    window_rule(),
    Rule(8, POST, POST_LABELS, ("post_control_count",), ("post_row_count",),
         "post_control_count", POST_ROWS, f"post_control_count = {POST_ROWS}"),
    Rule(9, POST, POST_LABELS, ("post_control_balance", "post_balance", "metadata_name"), (),
         "post_control_balance", POST_BALANCE, f"post_control_balance = {POST_BALANCE}"),
    Rule(10, PRE, EGRESS_LABELS, ("egress_source_count", "egress_target_count"), (),
         "egress_source_count", "egress_target_count", "egress_source_count = egress_target_count"),
    Rule(11, PRE, CHECKSUM_LABELS, ("digest", "is_duplicate"), (),
         f"if(is_duplicate, '{CHECKSUM}' || digest, null)", f"'{CHECKSUM}' || digest", "not is_duplicate"),
)


def _checked(measures: DataFrame, rule: Rule, key: str) -> DataFrame:
    return measures.selectExpr(
        key, f"{rule.source} as source_value", f"{rule.target} as target_value", f"{rule.status} as status"
    )


def _without_metadata(rule: Rule) -> Rule:
    return replace(rule, required=tuple(n for n in rule.required if n != "metadata_name"))


def zero_size_check(expected: DataFrame, profile: DataFrame, keys: list[str]) -> DataFrame:
    """Rule 0. Fails objects that are expected but empty or missing."""
    rule = RULES[0]
    return expected.join(profile, keys, "left").selectExpr(
        *keys, f"{rule.target} as text_size", f"{rule.status} as status"
    )


def count_control_check(control: DataFrame, profile: DataFrame) -> DataFrame:
    """Rule 1. Control count against rows landed, for every object with control metadata."""
    return _checked(control.join(profile, "object_name", "left"), RULES[1], "object_name")


def balance_control_check(control: DataFrame, profile: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """Rule 2. Control amount against the landed sum; objects without a number are errors.

    With ``metadata`` (``object_name, metadata_name``) an object also has to be known there.
    """
    measures = control.join(profile, "object_name", "left")
    if metadata is None:
        return _checked(measures, _without_metadata(RULES[2]), "object_name")
    return _checked(measures.join(metadata, "object_name", "left"), RULES[2], "object_name")


def threshold_check(bounds: DataFrame, profile: DataFrame) -> DataFrame:
    """Rule 3. Rows landed within ``min_value`` and ``max_value``, both included."""
    return _checked(bounds.join(profile, "object_name", "left"), RULES[3], "object_name")


def name_registered_check(expected: DataFrame, matches: DataFrame) -> DataFrame:
    """Rule 4. ``(file_name, match_count, status)``: the name occurs in the audit log."""
    return expected.join(matches, "file_name", "left").selectExpr(
        "file_name", f"{MATCHES} as match_count", f"{RULES[4].status} as status"
    )


def file_size_check(metadata: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Rule 5. Size in the audit log against the expected size."""
    return _checked(metadata.join(arrivals, "file_name", "left"), RULES[5], "file_name")


def arrival_status(metadata: DataFrame, arrivals: DataFrame, *, by_clock: bool = True) -> DataFrame:
    """Rule 6. On time from the early buffer up to the expected time, both included.

    ``by_clock`` compares times of day; otherwise whole timestamps are compared, so that a
    buffer may reach over midnight.
    """
    return _checked(metadata.join(arrivals, "file_name", "left"), arrival_rule(by_clock), "file_name")


def arrival_window_check(metadata: DataFrame, arrivals: DataFrame, *, by_clock: bool = True) -> DataFrame:
    """Rule 7. Arrived between the early and the late buffer, both left out."""
    return _checked(metadata.join(arrivals, "file_name", "left"), window_rule(by_clock), "file_name")


def post_count_check(control: DataFrame, profile: DataFrame) -> DataFrame:
    """Rule 8. Rule 1 for processed objects; the control may come from a query."""
    measures = control.join(profile, "object_name", "left").withColumnsRenamed(
        {"control_count": "post_control_count", "row_count": "post_row_count"}
    )
    return _checked(measures, RULES[8], "object_name")


def post_balance_check(control: DataFrame, profile: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """Rule 9. Rule 2 for processed objects."""
    measures = control.join(profile, "object_name", "left").withColumnsRenamed(
        {"control_balance": "post_control_balance", "balance": "post_balance"}
    )
    if metadata is None:
        return _checked(measures, _without_metadata(RULES[9]), "object_name")
    return _checked(measures.join(metadata, "object_name", "left"), RULES[9], "object_name")


def egress_count_check(counts: DataFrame, key: str) -> DataFrame:
    """Rule 10. Rows sent out against rows in the receiving store."""
    measures = counts.withColumnsRenamed(
        {"source_count": "egress_source_count", "target_count": "egress_target_count"}
    )
    return _checked(measures, RULES[10], key)


def duplicate_content_check(flagged: DataFrame, key: str) -> DataFrame:
    """Rule 11. Content that was seen before fails."""
    return flagged.selectExpr(key, "digest", "is_duplicate", f"{RULES[11].status} as status")
