"""The registered queries as DuckDB SQL over the given tables."""

from __future__ import annotations

# The row hashes, cut into 16 numbers and added up as vectors.
SUM_DIGEST = "'sum:' || sha256(count(*) || ':' || concat_ws(':', " + ", ".join(
    f"sum(cast('0x' || substr(sha256(row_text), {4 * i + 1}, 4) as bigint))" for i in range(16)) + "))"

# Tables that whole validation runs read as files: columns, balance column and bounds of the row count.
_FILES = {
    "region": (("r_name", "r_regionkey"), "r_regionkey", 1, 10),
    "nation": (("n_name", "n_nationkey", "n_regionkey"), "n_nationkey", 30, 40),
    "labels": (("doc_id", "quality", "toxic"), "quality", 1, 10**12),
    "benchmark": (("item_id", "text"), "item_id", 1, 10**12),
    "conversations": (("conv_id", "role", "text", "turn"), "turn", 1, 10**12),
    "documents": (("doc_id", "lang", "n_chars", "source", "text"), "n_chars", 1, 10**12),
    "orders": (("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"), "o_orderkey", 1, 10**12),
    "customer": (("c_acctbal", "c_custkey", "c_mktsegment", "c_name", "c_nationkey"), "c_nationkey", 1, 10**12),
    "events": (("event_id", "event_type", "props", "ts", "user_id", "value"), "user_id", 1, 10**12),
    "lineitem": (("l_discount", "l_extendedprice", "l_linenumber", "l_linestatus", "l_orderkey", "l_partkey", "l_quantity",
                  "l_returnflag", "l_shipdate", "l_suppkey", "l_tax"), "l_linenumber", 1, 10**12),
}


def _file(job: int, name: str) -> str:
    columns, balance, low, high = _FILES[name]
    cells = " || ".join(
        f"coalesce('{c}=' || length(cast({c} as varchar)) || ':' || cast({c} as varchar), '')" for c in columns)
    return (f"select {job} as job_id, '{name}' as object_name, {low} as low, {high} as high, "
            f"cast({balance} as bigint) as amount, {cells} as row_text from {name}")


def _cells(*cells: str) -> str:
    return " || ".join(f"length({c}) || ':' || {c}" for c in cells)


def _control(count: str, total: str) -> str:
    return f"'CNT=' || lpad(cast({count} as varchar), 19, '0') || ';BAL=0' || lpad(cast({total} as varchar), 19, '0')"


VIEWS = {
    "text_rows": f"""
        select 1 as job_id, 'orders' as object_name, 1 as low, 1000000000000 as high, cast(o_totalprice as decimal(18,2)) as amount,
               o_orderkey as line_no, {_cells("cast(o_orderkey as varchar)", "o_orderstatus", "cast(cast(o_totalprice as decimal(18,2)) as varchar)",
                        "note")} as row_text
        from (select *, 'as "' || o_orderstatus || '", by ' || o_custkey
                        || case when o_orderstatus = 'O' then chr(10) || 'open, still' else '' end as note from orders)
        union all select 2, 'customer', 1, 10, c_nationkey, c_custkey, {_cells(
            "'c_custkey'", "cast(c_custkey as varchar)", "'c_name'", "c_name", "'c_nationkey'", "cast(c_nationkey as varchar)")} from customer
        union all select 3, 'supplier', 1, 1000000000000, s_nationkey, s_suppkey, {_cells(
            "cast(s_suppkey as varchar)", "cast(s_nationkey as varchar)", "'x'")} from supplier
        union all select 3, 'supplier', 1, 1000000000000, 0, 1000000000000, {_cells("'0'", "'0'", "line")}
                  from (select {_control("count(*) + 1", "sum(s_nationkey)")} as line from supplier)
        union all select 4, 'part', 1, 1000000000000, p_partkey, p_partkey, {_cells("cast(p_partkey as varchar)", "p_brand", "'x'")} from part
        union all select 4, 'part', 1, 1000000000000, null, -1, {_cells("'p_partkey'", "'p_brand'", "line")}
                  from (select {_control("count(*) + 1", "sum(p_partkey)")} as line from part)""",
    "text_sums": f"""
        select job_id, object_name, low, high, count(*) as n, cast(trunc(sum(amount)) as bigint) as total,
               cast(sum(length(row_text)) as bigint) as size, {SUM_DIGEST} as digest
        from text_rows group by all""",
    "dated": """
        select 'u' || o_custkey as object_name, o_orderdate, cast(o_totalprice as decimal(18,2)) as amt,
               row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as ordinal,
               length(cast(o_orderkey as varchar)) || ':' || o_orderkey || length(o_orderstatus) || ':' || o_orderstatus
               || length(cast(cast(o_totalprice as decimal(18,2)) as varchar)) || ':'
               || cast(o_totalprice as decimal(18,2)) as row_text
        from orders""",
    "booked": """
        select o_orderkey, o_orderstatus, case when o_orderstatus = 'P' then floor(amt) else amt end as amt
        from (select o_orderkey, o_orderstatus, cast(o_totalprice as decimal(18,2)) as amt from orders)
        where o_orderkey in (select l_orderkey from lineitem)""",
    "due_slots": """
        select file_name, d + clock as due_time
        from (select file_name, clock, unnest(generate_series(a, b, interval 1 day)) as d
              from (select 'u' || user_id as file_name, cast(min(ts) as date) as a, cast(max(ts) as date) as b,
                           date_trunc('second', min(ts)) - date_trunc('day', min(ts)) as clock
                    from events group by user_id))""",
    "due_hits": """
        select distinct file_name, due_time, ts from due_slots join events on file_name = 'u' || user_id
            and ts >= due_time - interval 12 hour and ts < due_time + interval 12 hour""",
    "file_rows": " union all ".join(_file(job, name) for job, name in enumerate(_FILES, 1)),
    "file_sums": f"""
        select job_id, object_name, low, high, count(*) as n, cast(sum(amount) as bigint) as total,
               cast(sum(length(row_text)) as bigint) as size, {SUM_DIGEST} as digest
        from file_rows group by all""",
    "src": """
        select 'orders_' || strftime(o_orderdate, '%Y%m%d') || '.csv' as object_name, o_orderkey,
               cast(o_totalprice as decimal(18,2)) as amt, o_orderstatus = 'P' as pending
        from orders""",
    "landed": "select * from src where o_orderkey in (select l_orderkey from lineitem)",
    "manifest": """
        select object_name,
               'CNT=' || lpad(cast(count(*) as varchar), 19, '0') || ';BAL='
               || case when bool_or(pending) then 'open'
                       else case when trunc(sum(amt)) < 0 then '-' else '0' end
                            || lpad(cast(abs(cast(trunc(sum(amt)) as bigint)) as varchar), 19, '0') end as meta
        from src group by object_name""",
    "control": """
        select object_name, try_cast(substr(meta, 5, 19) as bigint) as control_count,
               try_cast(substr(meta, 29, 20) as bigint) as control_balance
        from manifest""",
    "profile": """
        select object_name, count(*) as row_count, cast(trunc(sum(amt)) as bigint) as balance
        from landed group by object_name""",
    "audit_log": """
        select event_id, 'u' || user_id || '_' || event_type as file_name, 'u' || user_id as user_file,
               case when event_type = 'error' then 'Post-' || event_type
                    when value < 1 then null else event_type end as product_name,
               cast(round(value * 100) as bigint) as file_size, ts as file_arrival_time
        from events""",
    "file_meta": """
        select file_name, date_trunc('minute', max(file_arrival_time)) as expected_time,
               cast(60 + count(*) * 20 as integer) as buffer_minutes,
               first(file_size order by file_arrival_time, event_id) as expected_file_size,
               date_trunc('minute', min(file_arrival_time)) as first_time
        from audit_log group by file_name""",
    "arrivals": """
        select * from (
            select *, count(*) over (partition by file_name) as match_count,
                   row_number() over (partition by file_name order by file_arrival_time, event_id) as rn
            from audit_log where product_name not like 'Post%')
        where rn = 1""",
    "timed": """
        select m.file_name, a.file_arrival_time as seen, m.expected_time as due,
               m.expected_time - to_minutes(m.buffer_minutes) as earliest,
               m.expected_time + to_minutes(m.buffer_minutes) as latest
        from file_meta m left join arrivals a using (file_name)""",
    "clocked": """
        select file_name, strftime(seen, '%H:%M:%S') as seen, strftime(due, '%H:%M:%S') as due,
               strftime(earliest, '%H:%M:%S') as earliest, strftime(latest, '%H:%M:%S') as latest
        from timed""",
    "segment_rules": """
        select * from (values
            ('AUTOMOBILE', [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]),
            ('BUILDING', [0, 1, 2, 3, 8, 9, 10]),
            ('FURNITURE', [1, 2, 3, 4, 8, 10, 11]),
            ('HOUSEHOLD', [0, 1, 3, 4, 6, 9, 10]),
            ('MACHINERY', [2, 3, 5, 7, 8, 9])) t(segment, rule_ids)""",
    "assignment": """
        select job_id, case when rule_id in (8, 9) then 'Post' else 'Pre' end as validation_type,
               cast(rule_id as integer) as rule_id
        from (select c_custkey as job_id, unnest(rule_ids) as rule_id
              from customer join segment_rules on segment = c_mktsegment)""",
    "job_args": """
        select c_custkey as job_id,
               case when c_acctbal < 0 then '' else 'u' || c_custkey end as object_name,
               case when c_mktsegment <> 'MACHINERY' then '/landing/' || c_custkey end as object_path,
               case when c_acctbal > 9000 then ' ' else '/curated/' || c_custkey end as object_path_post,
               case when c_acctbal < 2000 then 'SQLTable' when c_acctbal < 5000 then 'NASFile'
                    else 'File' end as object_type
        from customer""",
    "param_lines": """
        select p_partkey as pos,
               case when p_type = 'ECONOMY' then p_brand
                    else p_brand || ',' || p_name || ',' || p_type end as value
        from part""",
    "doc_digests": "select doc_id, sha256(text) as digest from documents",
    "registry": "select distinct digest from doc_digests where doc_id in (select doc_id from labels)",
    "new_arrivals": "select * from doc_digests where doc_id not in (select doc_id from labels)",
    "new_entries": """
        select digest, min(doc_id) as first_doc_id from new_arrivals
        where digest not in (select digest from registry) group by digest""",
    "doc_rows": """
        select source as object_name, doc_id,
               length(cast(doc_id as varchar)) || ':' || doc_id
               || coalesce(length(text) || ':' || text, '-') || coalesce(length(lang) || ':' || lang, '-')
               || coalesce(length(cast(n_chars as varchar)) || ':' || n_chars, '-') as row_text
        from documents""",
    "doc_tree": """
        select object_name, sum(n) as row_count,
               sha256(string_agg(digest, ',' order by chunk)) as digest
        from (select object_name, chunk, sum(n) as n, sha256(string_agg(digest, ',' order by block)) as digest
              from (select object_name, ordinal >> 20 as chunk, ordinal >> 10 as block, count(*) as n,
                           sha256(string_agg(sha256(row_text), ',' order by ordinal)) as digest
                    from (select object_name, row_text,
                                 row_number() over (partition by object_name order by doc_id) - 1 as ordinal
                          from doc_rows)
                    group by all)
              group by all)
        group by object_name""",
    # -- suite
    "cust_sent": """
        select 'u' || o_custkey as object_name, o_orderkey, o_orderstatus,
               cast(o_totalprice as decimal(18,2)) as amt,
               length(cast(o_orderkey as varchar)) || ':' || o_orderkey || length(o_orderstatus) || ':' || o_orderstatus
               || length(cast(cast(o_totalprice as decimal(18,2)) as varchar)) || ':'
               || cast(o_totalprice as decimal(18,2)) as row_text
        from orders""",
    "cust_sent_sums": f"""
        select object_name, count(*) as n, cast(trunc(sum(amt)) as bigint) as balance,
               {SUM_DIGEST} as digest
        from cust_sent group by object_name""",
    "cust_landed_sums": f"""
        select object_name, count(*) as n, cast(trunc(sum(amt)) as bigint) as balance,
               sum(length(row_text)) as text_size,
               {SUM_DIGEST} as digest
        from cust_sent where o_orderkey in (select l_orderkey from lineitem) group by object_name""",
    "cust_firsts": """
        select digest, min(object_name) as object_name from cust_landed_sums
        where digest not in (select digest from cust_sent_sums) group by digest""",
    "user_meta": """
        select user_file as object_name, date_trunc('minute', max(file_arrival_time)) as due,
               cast(60 + count(*) * 20 as integer) as buffer,
               min_by(file_size, file_arrival_time) as expected_size
        from audit_log group by user_file""",
    "user_arrivals": """
        select * from (
            select user_file as object_name, file_size, file_arrival_time as seen,
                   row_number() over (partition by user_file order by file_arrival_time, event_id) as rn
            from audit_log where product_name not like 'Post%')
        where rn = 1""",
    "measures": """
        select j.*, l.n as landed_n, l.balance as landed_balance, l.text_size, l.digest,
               s.n as sent_n, s.balance as sent_balance,
               case when l.digest is not null then f.object_name is null end as is_duplicate,
               a.file_size, m.expected_size, a.object_name is not null as registered,
               strftime(a.seen, '%H:%M:%S') as seen, strftime(m.due, '%H:%M:%S') as due,
               strftime(m.due - to_minutes(m.buffer), '%H:%M:%S') as earliest,
               strftime(m.due + to_minutes(m.buffer), '%H:%M:%S') as latest,
               coalesce(trim(j.object_name), '') = ''
                   or (coalesce(trim(j.object_path), '') = '' and j.object_type <> 'SQLTable') as pre_blank,
               coalesce(trim(j.object_name), '') = ''
                   or (coalesce(trim(j.object_path_post), '') = '' and j.object_type <> 'SQLTable') as post_blank
        from job_args j
        left join cust_landed_sums l using (object_name)
        left join cust_sent_sums s using (object_name)
        left join cust_firsts f using (object_name)
        left join user_arrivals a using (object_name)
        left join user_meta m using (object_name)""",
    "verdicts": """
        select job_id, object_name, object_type, pre_blank, post_blank, 0 as rule_id,
               cast(coalesce(text_size, 0) as varchar) as source_value,
               cast(coalesce(text_size, 0) as varchar) as target_value,
               coalesce(text_size, 0) <> 0 as holds, '' as missing
        from measures
        union all
        select job_id, object_name, object_type, pre_blank, post_blank, 1, cast(sent_n as varchar),
               cast(coalesce(landed_n, 0) as varchar), sent_n = coalesce(landed_n, 0),
               concat_ws(', ', case when sent_n is null then 'control_count' end)
        from measures
        union all
        select job_id, object_name, object_type, pre_blank, post_blank, 2, cast(sent_balance as varchar),
               cast(landed_balance as varchar), sent_balance = landed_balance,
               concat_ws(', ', case when sent_balance is null then 'control_balance' end,
                case when landed_balance is null then 'balance' end)
        from measures
        union all
        select job_id, object_name, object_type, pre_blank, post_blank, 3, 'MinValue = 5 and MaxValue = 15',
               cast(coalesce(landed_n, 0) as varchar), coalesce(landed_n, 0) between 5 and 15, ''
        from measures
        union all
        select job_id, object_name, object_type, pre_blank, post_blank, 4, object_name, object_name, registered, ''
        from measures
        union all
        select job_id, object_name, object_type, pre_blank, post_blank, 5, cast(file_size as varchar),
               cast(expected_size as varchar), file_size = expected_size,
               concat_ws(', ', case when file_size is null then 'audit_file_size' end,
                case when expected_size is null then 'expected_file_size' end)
        from measures
        union all
        select job_id, object_name, object_type, pre_blank, post_blank, 6, seen,
               'Postive_Buffer_Time = ' || latest || ' and Negative_Buffer_Time = ' || earliest,
               earliest <= seen and seen <= due,
               concat_ws(', ', case when seen is null then 'arrival_time' end, case when due is null then 'expected_time' end,
                case when due is null then 'buffer_minutes' end)
        from measures
        union all
        select job_id, object_name, object_type, pre_blank, post_blank, 7, seen,
               case when earliest < seen and seen < latest then 'File has arrived' else 'File has not arrived' end
               || ' in the time interval from ' || earliest || ' to ' || latest,
               earliest < seen and seen < latest,
               concat_ws(', ', case when seen is null then 'arrival_time' end, case when due is null then 'expected_time' end,
                case when due is null then 'buffer_minutes' end)
        from measures
        union all
        select job_id, object_name, object_type, pre_blank, post_blank, 8, cast(sent_n as varchar),
               cast(coalesce(landed_n, 0) as varchar), sent_n = coalesce(landed_n, 0),
               concat_ws(', ', case when sent_n is null then 'post_control_count' end)
        from measures
        union all
        select job_id, object_name, object_type, pre_blank, post_blank, 9, cast(sent_balance as varchar),
               cast(landed_balance as varchar), sent_balance = landed_balance,
               concat_ws(', ', case when sent_balance is null then 'post_control_balance' end,
                case when landed_balance is null then 'post_balance' end)
        from measures
        union all
        select job_id, object_name, object_type, pre_blank, post_blank, 10, cast(landed_n as varchar),
               cast(sent_n as varchar), landed_n = sent_n,
               concat_ws(', ', case when landed_n is null then 'egress_source_count' end,
                case when sent_n is null then 'egress_target_count' end)
        from measures
        union all
        select job_id, object_name, object_type, pre_blank, post_blank, 11,
               case when is_duplicate then 'Check_sum = ' || digest end, 'Check_sum = ' || digest, not is_duplicate,
               concat_ws(', ', case when digest is null then 'digest' end, case when is_duplicate is null then 'is_duplicate' end)
        from measures""",
    "rule_names": """
        select * from (values
            (0, 'Zero FileSize Validation', 'Passed', 'Source File', 'Target File'),
            (1, 'CountValidation', 'passed', 'Source Count', 'Target Count'),
            (2, 'BalanceAmountValidation', 'passed', 'Source Balance Amount', 'Target Balance Amount'),
            (3, 'ThresholdValidation', 'passed', 'Source Threshold Value', 'Target Object Count'),
            (4, 'FileNameValidation', 'passed', 'Object Name', 'Object Name'),
            (5, 'File Size Validation', 'passed', 'Source Object Size', 'Target Object Size'),
            (6, 'FileArrival_Validation', 'passed', 'Source Object Arrival Time', 'Target Object Arrival Time'),
            (7, 'Missing_FileCheck_Validation', 'passed', 'Source Object Arrival Time', 'Target Expected Time'),
            (8, 'CountValidation Post File Processing', 'passed',
             'Source Count Post Object Processing', 'Target Count Post Object Processing'),
            (9, 'BalanceAmountValidation Post File Processing', 'passed',
             'Source Balance Amount Post Object Processing', 'Target Balance Amount Post Object Processing'),
            (10, 'CountValidation for Egress', 'passed',
             'Source Count for Egress Object', 'Target Count for Egress Object'),
            (11, 'Duplicate_File_Check_Validation', 'Passed', 'Source Check Sum', 'Target Check Sum')
        ) t(rule_id, title, passed_word, source_value_type, target_value_type)""",
    "judged": """
        select v.*, n.title, n.passed_word, n.source_value_type, n.target_value_type, a.validation_type,
               case when a.validation_type = 'Post' then post_blank else pre_blank end as is_blank,
               case when missing <> '' then 'Error'
                    when v.rule_id = 6 then case when holds then 'On Time' else 'Delay' end
                    when holds then 'Passed' else 'Failed' end as status
        from verdicts v join rule_names n using (rule_id)
        join (select distinct job_id, validation_type, rule_id from assignment) a
             on a.job_id = v.job_id and a.rule_id = v.rule_id""",
    "texted": """
        select *, case when status = 'Error' then 'Error Message : no value for ' || missing
                       when status = 'Failed' then title || ' Failed'
                       else title || ' ' || passed_word end as text,
               status = 'Error' or (rule_id = 0 and status = 'Failed') as stops
        from judged""",
    "ran": """
        select * from (
            select *, coalesce(bool_or(stops) over (partition by job_id, validation_type order by rule_id
                               rows between unbounded preceding and 1 preceding), false) as stopped
            from texted where not is_blank)
        where not stopped""",
    "logged": """
        select job_id, rule_id, object_name, source_value, target_value, source_value_type, target_value_type,
               case when rule_id = 0 then case object_type when 'File' then 'ADLS RAW Layer'
                         when 'NASFile' then 'Fileshare File' else 'SQL Table' end
                    when rule_id = 10 then 'ADLS' when rule_id = 11 then 'File CheckSum Table'
                    else 'Audit Table' end as source_name,
               case when rule_id = 0 then case object_type when 'File' then 'ADLS Curated Layer'
                         when 'NASFile' then 'ADLS RAW Layer' else 'ADL RAW layer' end
                    when rule_id = 10 then 'SQL Server' when rule_id in (8, 9) then 'ADLS'
                    else case object_type when 'File' then 'ADLS Raw Layer' when 'NASFile' then 'NAS Drive'
                         else 'Azure SQL Server' end end as target_name,
               status as rule_run_status, '2024-02-01 06:30:00.123' as created_time, 'recon' as created_by
        from ran where status <> 'Error'""",
    "summaries": """
        with stages as (
            select job_id, object_name, 'Pre' as validation_type, pre_blank as is_blank from measures
            union all
            select job_id, object_name, 'Post', post_blank from measures)
        select s.job_id, s.object_name, s.validation_type, s.is_blank,
               count(*) filter (r.status <> 'Error') as rules_run,
               count(*) filter (r.status = 'Failed') as rules_failed,
               s.is_blank or coalesce(bool_or(r.stops), false) as aborted,
               coalesce(bool_or(r.status = 'Error'), false) as in_error,
               max(r.rule_id) filter (r.status = 'Error') as error_rule,
               case when s.is_blank and s.validation_type = 'Pre'
                    then 'Error Message : ObjectName or Path is blank in Pre Validation Wrapper Function'
                    when s.is_blank then 'Error Message : ObjectName or Path is blank in Post Wrapper Function'
                    else coalesce(max(r.text) filter (r.status = 'Error'),
                                  string_agg(r.text, ' | ' order by r.rule_id), '') end as summary
        from stages s left join ran r on r.job_id = s.job_id and r.validation_type = s.validation_type
        group by s.job_id, s.object_name, s.validation_type, s.is_blank""",
    # -- runs
    "batch_starts": "select o_custkey as batch_id, min(o_orderdate) as batch_start_time from orders group by 1",
    "batch_runs": """
        select strftime(batch_start_time, '%Y%m%d%H%M%S') || '-'
               || sha256(batch_id || '|orders|' || strftime(batch_start_time, '%Y-%m-%d %H:%M:%S') || '.000')
               as execution_run_id, batch_id, batch_start_time
        from batch_starts""",
    "batch_ends": """
        select o_custkey as batch_id, max(o_orderdate) as batch_end_time from orders
        group by 1 having max_by(o_orderstatus, o_orderkey) <> 'P'""",
    "job_ends": """
        select l_orderkey as job_id, max(l_shipdate) as job_end_time, count(*) as source_count,
               count(*) filter (l_linestatus = 'F') as target_count
        from lineitem group by 1""",
    "job_runs": """
        select o_orderkey as job_id, execution_run_id, o_orderdate as job_start_time,
               sha256(o_orderkey || '|/orders/' || o_orderkey || '|'
                      || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.000') as job_run_id
        from orders join batch_runs on batch_id = o_custkey""",
    "files": """
        select l_orderkey * 10 + l_linenumber as file_id, l_orderkey as job_id, max(l_shipdate) as load_end_time,
               count(*) as source_count, count(*) filter (l_linestatus = 'F') as target_count
        from lineitem group by l_orderkey, l_linenumber""",
}

_VALIDATED = """
        select job_id, object_name, 0 as rule_id, cast(size as varchar) as source_value,
               cast(size as varchar) as target_value, 'Passed' as status, 'Zero FileSize Validation Passed' as text
        from file_sums
        union all select job_id, object_name, 1, cast(n as varchar), cast(n as varchar), 'Passed',
                         'CountValidation passed' from file_sums
        union all select job_id, object_name, 2, cast(total as varchar), cast(total as varchar), 'Passed',
                         'BalanceAmountValidation passed' from file_sums
        union all select job_id, object_name, 3, 'MinValue = ' || low || ' and MaxValue = ' || high, cast(n as varchar),
                         case when n between low and high then 'Passed' else 'Failed' end,
                         'ThresholdValidation ' || case when n between low and high then 'passed' else 'Failed' end
                  from file_sums
        union all select job_id, object_name, 11, null, 'Check_sum = ' || digest, 'Passed',
                         'Duplicate_File_Check_Validation Passed' from file_sums
        union all select 90, 'sheet', 0, null, null, 'Error', 'Error Message : no value for text_size'
        union all select 91, 'absent', 0, '0', '0', 'Failed', 'Zero FileSize Validation Failed'
        union all select 92, 'nowhere', null, null, null, null, null"""

BODIES = {
    "validate_text": _VALIDATED.split("union all select 90,")[0].replace("file_sums", "text_sums"),
    "validate_text_ordered": """
        select job_id, object_name, 11 as rule_id, null as source_value, 'Check_sum = tree:' || digest as target_value,
               'Passed' as status, 'Duplicate_File_Check_Validation Passed' as text
        from (select job_id, object_name, sha256(string_agg(digest, ',' order by chunk)) as digest
              from (select job_id, object_name, chunk, sha256(string_agg(digest, ',' order by block)) as digest
                    from (select job_id, object_name, ordinal >> 20 as chunk, ordinal >> 10 as block,
                                 sha256(string_agg(sha256(row_text), ',' order by ordinal)) as digest
                          from (select *, row_number() over (partition by job_id order by line_no) - 1 as ordinal from text_rows where job_id > 2)
                          group by all)
                    group by all)
              group by all)""",
    "registry_lookup": "select digest, first_doc_id from new_entries",
    "changed_objects": """
        with a as (select object_name, count(*) as n from src group by 1), b as (select object_name, count(*) as n from landed group by 1)
        select a.object_name as file, case when b.n is null then 'Gone' when a.n = b.n then 'Same' else 'Changed' end as state
        from a left join b on a.object_name = b.object_name""",
    "control_cells_file": f"""
        select 'supplier' as object_name, 'Header' as place, 'note' as meta_string
        union all select 'supplier', 'Footer', {_control("count(*) + 1", "sum(s_nationkey)")} from supplier
        union all select 'part', 'Header', {_control("count(*) + 1", "sum(p_partkey)")} from part
        union all select 'part', 'Footer', 'x'""",
    "store_differences": """
        with held as (
            select * from booked union all select -o_orderkey, o_orderstatus, amt from booked where amt > 450000),
        a as (select o_orderkey, count(*) as n, list((o_orderstatus, cast(amt as decimal(18,2))) order by amt) as v
              from (select o_orderkey, o_orderstatus, cast(o_totalprice as decimal(18,2)) as amt from orders) group by 1),
        b as (select o_orderkey, count(*) as n, list((o_orderstatus, cast(amt as decimal(18,2))) order by amt) as v from held group by 1)
        select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey, coalesce(a.n, 0) as source_rows, coalesce(b.n, 0) as target_rows,
               case when b.n is null then 'Missing' when a.n is null then 'Extra' else 'Changed' end as difference
        from a full join b on a.o_orderkey = b.o_orderkey where a.v is distinct from b.v""",
    "arrival_calendar": """
        with found as (
            select d.file_name, d.due_time, min(h.ts) as seen, count(h.ts) as n from due_slots d
            left join (select h.file_name, h.due_time, e.ts from due_hits h join events e on h.file_name = 'u' || e.user_id and h.ts = e.ts) h
                on h.file_name = d.file_name and h.due_time = d.due_time
            group by all),
        others as (
            select 'u' || user_id as file_name, min(ts) as seen, count(*) as n from events
            where ('u' || user_id, ts) not in (select (file_name, ts) from due_hits) group by 1)
        select file_name, strftime(due_time, '%Y-%m-%d %H:%M:%S.%f') as due_time, strftime(seen, '%Y-%m-%d %H:%M:%S.%f') as arrival_time,
               n as arrivals, case when seen is null then 'Missing' when seen < due_time - interval 30 minute then 'Early'
                                   when seen > due_time + interval 60 minute then 'Late' else 'On Time' end as status
        from found
        union all select file_name, null, strftime(seen, '%Y-%m-%d %H:%M:%S.%f'), n, 'Unexpected' from others""",
    "chunk_differences": """
        with sent as (
            select *, (row_number() over (partition by object_name order by o_orderkey) - 1) // 4 as chunk from src),
        here as (
            select *, (row_number() over (partition by object_name order by o_orderkey) - 1) // 4 as chunk from landed),
        a as (select object_name, chunk, count(*) as n, list(o_orderkey order by o_orderkey) as v from sent group by all),
        b as (select object_name, chunk, count(*) as n, list(o_orderkey order by o_orderkey) as v from here group by all),
        found as (
            select coalesce(a.object_name, b.object_name) as object_name, sum(a.n) as stored_rows, sum(b.n) as row_count,
                   min(coalesce(a.chunk, b.chunk)) filter (a.v is distinct from b.v) as first_chunk,
                   coalesce(bool_or(a.n = 4 and a.v is distinct from b.v), false) as broken
            from a full join b on a.object_name = b.object_name and a.chunk = b.chunk group by 1)
        select object_name, coalesce(stored_rows, 0)::bigint as stored_rows, coalesce(row_count, 0)::bigint as row_count, first_chunk,
               case when first_chunk is null then least(coalesce(stored_rows, 0), coalesce(row_count, 0))
                    else least(coalesce(stored_rows, 0), coalesce(row_count, 0), first_chunk * 4) end::bigint as equal_rows,
               case when stored_rows is null then 'New' when row_count is null then 'Gone' when first_chunk is null then 'Same'
                    when not broken and row_count > stored_rows then 'Grown' else 'Changed' end as state
        from found""",
    "grown_digests": """
        select object_name, count(*) as row_count, count(*) - 4 * (count(*) filter (o_orderdate < timestamp '1997-07-01') // 4) as rehashed_rows,
               any_value(digest) as digest
        from dated join (
            select object_name, 'tree:' || sha256(string_agg(digest, ',' order by chunk)) as digest
            from (select object_name, ordinal // 4 as chunk, sha256(string_agg(sha256(row_text), ',' order by ordinal)) as digest
                  from dated group by all) group by 1) using (object_name)
        group by object_name""",
    "profile_from_daily_state": f"""
        select object_name, count(*) as row_count, cast(trunc(sum(amt)) as bigint) as balance,
               cast(sum(length(row_text)) as bigint) as text_size, {SUM_DIGEST} as digest,
               strftime(min(o_orderdate), '%Y-%m-%d') as first_day, strftime(max(o_orderdate), '%Y-%m-%d') as last_day
        from dated group by object_name""",
    "validate_pre": _VALIDATED,
    "validate_post": """
        select job_id, object_name, 8 as rule_id, cast(n as varchar) as source_value, cast(n as varchar) as target_value,
               'Passed' as status, 'CountValidation Post File Processing passed' as text
        from file_sums
        union all select job_id, object_name, 9, cast(total as varchar), cast(total as varchar), 'Passed',
                         'BalanceAmountValidation Post File Processing passed' from file_sums
        union all select 90, 'sheet', 8, null, null, 'Error',
                         'Error Message : no value for post_control_count, post_row_count'
        union all select 91, 'absent', 8, null, '0', 'Error', 'Error Message : no value for post_control_count'
        union all select 92, 'nowhere', null, null, null, null, null""",
    "object_profile": "select * from profile",
    "control_parse": "select * from control",
    "control_first_last": """
        select object_name, cast(min_by(amt, o_orderkey) as varchar) as first_value,
               cast(max_by(amt, o_orderkey) as varchar) as last_value
        from src group by object_name""",
    "zero_size_check": """
        with slots as (
            select user_id, unnest(generate_series(min(cast(ts as date)), max(cast(ts as date)), interval 1 day)) as d
            from events group by user_id),
        sizes as (
            select user_id, cast(ts as date) as d,
                   sum(length(length(cast(event_id as varchar)) || ':' || event_id
                       || length(cast(ts as varchar)) || ':' || cast(ts as varchar)
                       || length(cast(user_id as varchar)) || ':' || user_id
                       || coalesce(length(event_type) || ':' || event_type, '-')
                       || coalesce(length(cast(value as varchar)) || ':' || cast(value as varchar), '-')
                       || coalesce(length(props) || ':' || props, '-'))) as text_size
            from events group by all)
        select s.user_id, strftime(s.d, '%Y-%m-%d') as slot_date, cast(coalesce(z.text_size, 0) as bigint) as text_size,
               case when coalesce(z.text_size, 0) <> 0 then 'Passed' else 'Failed' end as status
        from slots s left join sizes z on z.user_id = s.user_id and z.d = cast(s.d as date)""",
    "count_control_check": """
        select object_name, control_count as source_value, coalesce(row_count, 0) as target_value,
               case when control_count = coalesce(row_count, 0) then 'Passed' else 'Failed' end as status
        from control left join profile using (object_name)""",
    "balance_control_check": """
        select object_name, control_balance as source_value, balance as target_value,
               case when balance is null or control_balance is null then 'Error'
                    when control_balance = balance then 'Passed' else 'Failed' end as status
        from control left join profile using (object_name)""",
    "threshold_check": """
        select object_name, 'MinValue = 4 and MaxValue = 9' as source_value, coalesce(row_count, 0) as target_value,
               case when coalesce(row_count, 0) between 4 and 9 then 'Passed' else 'Failed' end as status
        from manifest left join profile using (object_name)""",
    "audit_pre_filter": "select event_id, file_name, product_name from audit_log where product_name not like 'Post%'",
    "audit_post_filter": "select event_id, file_name, product_name from audit_log where product_name like 'Post%'",
    "first_arrival": """
        select file_name, event_id, strftime(file_arrival_time, '%H:%M:%S') as arrival_time_of_day from arrivals""",
    "name_registered_check": """
        select file_name, coalesce(n, 0) as match_count,
               case when coalesce(n, 0) > 0 then 'Passed' else 'Failed' end as status
        from file_meta left join (select file_name, count(*) as n from audit_log
                                  where product_name not like 'Post%' group by 1) using (file_name)""",
    "file_size_check": """
        select file_name, file_size as source_value, expected_file_size as target_value,
               case when file_size is null then 'Error'
                    when file_size = expected_file_size then 'Passed' else 'Failed' end as status
        from file_meta left join arrivals using (file_name)""",
    "arrival_status": """
        select file_name, seen as source_value,
               'Postive_Buffer_Time = ' || latest || ' and Negative_Buffer_Time = ' || earliest as target_value,
               case when seen is null then 'Error'
                    when earliest <= seen and seen <= due then 'On Time' else 'Delay' end as status
        from clocked""",
    "arrival_window_check": """
        select file_name, seen as source_value,
               case when earliest < seen and seen < latest then 'File has arrived' else 'File has not arrived' end
               || ' in the time interval from ' || earliest || ' to ' || latest as target_value,
               case when seen is null then 'Error'
                    when earliest < seen and seen < latest then 'Passed' else 'Failed' end as status
        from clocked""",
    "arrival_window_by_timestamp": """
        with due as (
            select m.file_name, a.file_arrival_time as seen, m.first_time - to_minutes(m.buffer_minutes) as earliest,
                   m.first_time + to_minutes(m.buffer_minutes) as latest
            from file_meta m left join arrivals a using (file_name))
        select file_name, strftime(seen, '%H:%M:%S') as source_value,
               case when earliest < seen and seen < latest then 'File has arrived' else 'File has not arrived' end
               || ' in the time interval from ' || strftime(earliest, '%H:%M:%S')
               || ' to ' || strftime(latest, '%H:%M:%S') as target_value,
               case when seen is null then 'Error'
                    when earliest < seen and seen < latest then 'Passed' else 'Failed' end as status
        from due""",
    "post_count_check": """
        select object_name, s.n as source_value, coalesce(row_count, 0) as target_value,
               case when s.n = coalesce(row_count, 0) then 'Passed' else 'Failed' end as status
        from (select object_name, count(*) as n from src group by 1) s left join profile using (object_name)""",
    "post_balance_check": """
        select object_name, s.b as source_value, balance as target_value,
               case when balance is null then 'Error' when s.b = balance then 'Passed' else 'Failed' end as status
        from (select object_name, cast(trunc(sum(amt)) as bigint) as b from src group by 1) s
        left join profile using (object_name)""",
    "egress_count_reconcile": """
        select coalesce(a.batch_id, b.batch_id) as batch_id, coalesce(a.n, 0) as source_value,
               coalesce(b.n, 0) as target_value,
               case when coalesce(a.n, 0) = coalesce(b.n, 0) then 'Passed' else 'Failed' end as status
        from (select o_custkey as batch_id, count(*) as n from orders group by 1) a
        full join (select o_custkey as batch_id, count(distinct l_orderkey) as n
                   from lineitem join orders on o_orderkey = l_orderkey group by 1) b on a.batch_id = b.batch_id""",
    "egress_total_reconcile": """
        select 'orders' as object_name, a.n as source_value, b.n as target_value,
               case when a.n = b.n then 'Passed' else 'Failed' end as status
        from (select count(*) as n from orders) a,
             (select count(distinct l_orderkey) as n from lineitem join orders on o_orderkey = l_orderkey) b""",
    "content_digest": "select object_name, cast(row_count as bigint) as row_count, 'tree:' || digest as digest from doc_tree",
    "content_digest_unordered": f"""
        select object_name, count(*) as row_count,
               {SUM_DIGEST} as digest
        from doc_rows group by object_name""",
    "duplicate_content_check": """
        select a.doc_id, a.digest, e.first_doc_id is null as is_duplicate,
               case when e.first_doc_id is null then 'Failed' else 'Passed' end as status
        from new_arrivals a left join new_entries e on e.first_doc_id = a.doc_id""",
    "checksum_new_entries": "select digest, first_doc_id from new_entries",
    "rule_assignment_topn": """
        select * from (select job_id, validation_type, rule_id,
                              row_number() over (partition by job_id, validation_type order by rule_id) as rn
                       from assignment)
        where rn <= 4""",
    "blank_object_guard": """
        select job_id, case when coalesce(trim(object_name), '') = ''
                             or (coalesce(trim(object_path), '') = '' and object_type <> 'SQLTable')
                            then 'Error' else 'Passed' end as status
        from job_args""",
    "param_lookup": """
        with firsts as (
            select split_part(value, ',', 1) as param_key, min_by(value, pos) as value from param_lines group by 1)
        select k.param_key, coalesce(case when contains(f.value, ',')
                                          then substr(f.value, strpos(f.value, ',') + 1) end, '') as param_value
        from (select p_brand as param_key from part union select n_name from nation) k
        left join firsts f using (param_key)""",
    "suite_results": "select * from logged",
    "suite_summary": """
        select job_id, rules_run, rules_failed, aborted, summary from summaries where validation_type = 'Pre'""",
    "post_suite_summary": """
        select job_id, rules_run, rules_failed, aborted, summary from summaries where validation_type = 'Post'""",
    "validation_log": """
        select job_id, row_number() over (partition by job_id order by rule_id) as seq,
               '2024-02-01 06:30:00.123 ' || case when status = 'Error' then 'Error Occured ' else '' end || text as line
        from ran where validation_type = 'Pre'
        union all
        select s.job_id, count(r.rule_id) + 1, '2024-02-01 06:30:00.123 ' || s.summary
        from summaries s left join ran r on r.job_id = s.job_id and r.validation_type = 'Pre'
        where s.validation_type = 'Pre' group by s.job_id, s.summary""",
    "error_log": """
        select cast(null as varchar) as execution_run_id,
               case when is_blank then 'BLANK_OBJECT' else 'RULE_' || error_rule end as error_code,
               sha256(job_id || '|Pre|' || case when is_blank then 'blank' else cast(error_rule as varchar) end
                      || '|2024-02-01 06:30:00.123') as error_id,
               summary as error_message, 'Validation' as error_type, object_name,
               cast(job_id as varchar) as object_run_id, '2024-02-01 06:30:00.123' as created_date
        from summaries where validation_type = 'Pre' and (is_blank or in_error)""",
    "batch_run_stats": """
        select execution_run_id, cast(batch_id as varchar) as batch_id,
               strftime(batch_start_time, '%Y-%m-%d %H:%M:%S') as batch_start_time,
               strftime(batch_end_time, '%Y-%m-%d %H:%M:%S') as batch_end_time,
               case when batch_end_time is null then 'Started' else 'Completed' end as status
        from batch_runs left join batch_ends using (batch_id)""",
    "job_run_stats": """
        select job_id, execution_run_id, source_count, target_count, coalesce(source_count - target_count, 0) as reject_count,
               datesub('second', job_start_time, job_end_time) as duration_in_seconds,
               case when job_end_time is null then 'Started' else 'Completed' end as status
        from job_runs left join job_ends using (job_id)""",
    "file_run_stats": """
        select file_id, job_run_id, execution_run_id,
               case when load_end_time >= job_start_time then source_count end as source_count,
               case when load_end_time >= job_start_time then target_count end as target_count,
               case when load_end_time >= job_start_time
                    then datesub('second', job_start_time, load_end_time) end as duration_in_seconds,
               case when load_end_time >= job_start_time then 'Completed' else 'Started' end as status
        from files join job_runs using (job_id)""",
    "run_lineage": """
        select file_id, job_id, cast(batch_id as varchar) as batch_id, execution_run_id
        from files join orders on o_orderkey = job_id
        join (select * from batch_runs where batch_id not in (select batch_id from batch_ends)) on batch_id = o_custkey""",
}


def _sql(body: str) -> str:
    """``body`` with the views it uses, and the ones those use, in front of it."""
    needed: list[str] = []

    def add(text: str) -> None:
        words = set("".join(c if c.isalnum() or c == "_" else " " for c in text).split())
        for name in VIEWS:
            if name in words and name not in needed:
                add(VIEWS[name])
                needed.append(name)

    add(body)
    if not needed:
        return body.strip()
    ctes = ",\n".join(f"{name} as ({VIEWS[name].strip()})" for name in needed)
    body = body.strip()
    if body.startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


ORACLES = {name: _sql(body) for name, body in BODIES.items()}
