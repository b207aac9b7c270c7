"""The same results in SQL, over the same tables (DuckDB dialect)."""

# Values of 2 or 3 decimals add up exactly as decimals.
_FOLD = """count(*) AS count,
  cast(sum(cast({v} AS decimal(18,4))) AS double) AS sum,
  min({v}) AS min, max({v}) AS max,
  cast(sum(cast({v} AS decimal(18,4))) AS double) / count(*) AS avg"""

_EVENTS = """(SELECT event_id + 1 AS line_no, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
  event_type AS level, 'svc-' || (user_id % 4) AS source, props AS message, value,
  event_id % 50 AS m FROM events)"""

_CUSTOMERS = """(SELECT c_custkey + 1 AS line_no, '2024-01-01T00:00:00Z' AS timestamp,
  c_mktsegment AS level, 'nation-' || c_nationkey AS source, c_name AS message,
  c_acctbal AS value FROM customer)"""

_BAD = "(1, 2, 3, 4, 5, 8, 9, 10)"

# What decoding the damaged lines gives back.
_DIRTY = f"""(SELECT line_no, CASE WHEN m = 11 THEN '' ELSE timestamp END AS timestamp, level,
  CASE WHEN m = 7 THEN '=' || source ELSE source END AS source, message, value, m
  FROM {_EVENTS} WHERE m <> 0 AND m NOT IN {_BAD})"""

_STATUS = """CASE WHEN m = 0 THEN 'blank' WHEN m IN (1, 2, 8) THEN 'column_count'
  WHEN m IN (3, 9) THEN 'non_numeric' WHEN m = 4 THEN 'nan_value'
  WHEN m IN (5, 10) THEN 'bad_quoting' ELSE 'ok' END"""

_REASON = """CASE m WHEN 1 THEN 'expected 5 columns but found 4'
  WHEN 2 THEN 'expected 5 columns but found 6' WHEN 8 THEN 'expected 5 columns but found 1'
  WHEN 3 THEN 'non-numeric value: ''abc''' WHEN 9 THEN 'non-numeric value: ''nan'''
  WHEN 4 THEN 'value must not be NaN'
  ELSE 'quoted field does not end at a comma or line end' END"""

_RECORD = "line_no, timestamp, level, source, message, value"


def _guard(x):
    return f"""CASE WHEN left({x}, 1) IN ('=', '+', '-', '@', chr(9), chr(13))
      THEN '''' || {x} ELSE {x} END"""


def _quote(x):
    return f"""CASE WHEN contains({x}, ',') OR contains({x}, '"')
      THEN '"' || replace({x}, '"', '""') || '"' ELSE {x} END"""


def _escape(x):
    return _quote(f"({_guard(x)})")


def _line(value="value", message="message"):
    fields = ["timestamp", "level", "source", message]
    return " || ',' || ".join([f"({_escape(f)})" for f in fields] + [f"cast({value} AS varchar)"])


def _fold(table, where="true", value="value"):
    return f"SELECT {_FOLD.format(v=value)} FROM {table} WHERE {where}"


def _events(where="true", columns=_RECORD):
    return f"SELECT {columns} FROM {_EVENTS} WHERE {where}"


def _customers(where):
    return f"SELECT {_RECORD} FROM {_CUSTOMERS} WHERE {where}"


_LINEITEM = "(SELECT l_returnflag AS level, l_extendedprice AS value FROM lineitem)"

_DOCUMENTS = """(SELECT doc_id + 1 AS line_no, '2024-01-01T00:00:00Z' AS timestamp,
  lang AS level, source, replace(replace(text, chr(13), ' '), chr(10), ' ') AS message,
  cast(n_chars AS double) AS value FROM documents)"""

_TRIM = r"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"

_PARTIALS = f"""SELECT (line_no - 1) // 2000 AS chunk_id, {_FOLD.format(v='value')}
  FROM {_EVENTS} GROUP BY 1"""

# Batches of 50 lines, values from 200 halved; also those with no record left.
_BATCHES = f"""(SELECT (line_no - 1) // 50 AS sequence,
  count(*) FILTER (value >= 200) AS count,
  coalesce(list_reduce(list(value * 0.5 ORDER BY line_no) FILTER (value >= 200),
    lambda a, b: a + b), 0.0) AS sum,
  min(value * 0.5) FILTER (value >= 200) AS min,
  max(value * 0.5) FILTER (value >= 200) AS max,
  coalesce(string_agg({_line('value * 0.5')}, chr(10) ORDER BY line_no)
    FILTER (value >= 200), '') AS output
  FROM {_EVENTS} GROUP BY 1)"""

_BATCH_LINES = f"""(SELECT (line_no - 1) // 50 AS sequence,
  cast(row_number() OVER (PARTITION BY (line_no - 1) // 50 ORDER BY line_no) - 1 AS integer) AS pos,
  {_line('value * 0.5')} AS line FROM {_EVENTS} WHERE value >= 200)"""

_SUMMARY = f"""(SELECT count(*) AS lines_read, count(*) FILTER (m = 0) AS blank,
  count(*) FILTER (m IN {_BAD}) AS malformed,
  count(*) FILTER (m <> 0 AND m NOT IN {_BAD} AND NOT ({{keep}})) AS filtered_out,
  count(*) FILTER (m <> 0 AND m NOT IN {_BAD} AND ({{keep}})) AS records
  FROM {_EVENTS})"""

_ERROR_CLICK = "level IN ('error', 'click')"

# The damage of kind 7 changes the source.
_SOURCE_KEPT = "source IN ('svc-0', 'svc-2') AND m <> 7"

_DIRTY_WIDTH = f"""CASE m WHEN 0 THEN 0 WHEN 8 THEN 3
  WHEN 1 THEN length({_line()}) - length(cast(value AS varchar)) - 1
  WHEN 2 THEN length({_line()}) + 6
  WHEN 3 THEN length({_line()}) - length(cast(value AS varchar)) + 3
  WHEN 4 THEN length({_line()}) - length(cast(value AS varchar)) + 3
  WHEN 9 THEN length({_line()}) - length(cast(value AS varchar)) + 3
  WHEN 5 THEN length({_line()}) - 1
  WHEN 6 THEN length({_line()}) + 10
  WHEN 7 THEN length({_line()}) + 1
  WHEN 10 THEN length({_line()}) + 1
  WHEN 11 THEN length({_line()}) - length(timestamp)
  WHEN 12 THEN length({_line()}) + 1
  ELSE length({_line()}) END"""

_LINES = "(SELECT line_no, " + _line() + " AS line FROM " + _EVENTS + ")"

_TWO_FOLDERS = f"""(SELECT 0 AS f, line_no, {_line()} AS line, value, level FROM {_CUSTOMERS}
  UNION ALL SELECT 1, line_no, {_line()}, value, level FROM {_DIRTY})"""

# Rows of typed files: every seventh has no value, every eleventh no source.
_TYPED_RUN = f"""SELECT row_number() OVER (ORDER BY line_no) AS line_no, {_line()} AS line, c.*
  FROM {_EVENTS}, (SELECT count(*) AS lines_read,
    count(*) FILTER (line_no % 7 = 0 OR line_no % 11 = 0) AS malformed,
    count(*) FILTER (line_no % 7 = 0 OR line_no % 11 = 0) AS dead,
    count(*) FILTER (line_no % 11 = 0) AS no_source FROM {_EVENTS}) c
  WHERE line_no % 7 <> 0 AND line_no % 11 <> 0 AND {_ERROR_CLICK}"""

_EIGHTH = "(floor(value * 4) / 8)"

ORACLES = {
    "q_flagship": _fold(
        _EVENTS, "level IN ('error', 'purchase') AND value BETWEEN 5 AND 100", "value * 0.5"
    ),
    "q_lineitem_pipeline": _fold(
        _LINEITEM, "level IN ('A', 'N') AND value BETWEEN 1000 AND 60000", "value * 0.5"
    ),
    "q_decode_clean": _events(),
    "q_decode_dirty": f"SELECT {_RECORD} FROM {_DIRTY}",
    "q_decode_documents": f"""SELECT line_no, timestamp, level, source,
      {_TRIM.format(x=f"({_guard('message')})")} AS message,
      value FROM {_DOCUMENTS}""",
    "q_line_status": f"SELECT {_STATUS} AS status, count(*) AS lines FROM {_EVENTS} GROUP BY 1",
    "q_dead_letter": f"""SELECT line_no, {_STATUS} AS status,
      'Malformed CSV at line ' || line_no || ': ' || {_REASON} AS message
      FROM {_EVENTS} WHERE m IN {_BAD}""",
    "q_filter_level": _events("level IN ('error', 'purchase')"),
    "q_filter_source": _events("source IN ('svc-1', 'svc-3')"),
    "q_filter_range": _customers("value BETWEEN -500 AND 500"),
    "q_filter_min_only": _customers("value >= -100"),
    "q_filter_max_only": _customers("value <= 0"),
    "q_filter_and": _events("level = 'view' AND value >= 20"),
    "q_filter_or": _events("level = 'signup' OR source = 'svc-2'"),
    "q_filter_options": _events(f"{_ERROR_CLICK} AND source = 'svc-1' AND value BETWEEN 10 AND 60"),
    "q_filter_accept_all": _events(),
    "q_custom_predicate": _events("length(message) % 2 = 0"),
    "q_scale": _events(columns="line_no, timestamp, level, source, message, value * 0.5 AS value"),
    "q_upper_level": _events(
        columns="line_no, timestamp, upper(level) AS level, source, message, value"
    ),
    "q_custom_transform": _events(
        columns="line_no, timestamp, level, source, level || ': ' || message AS message, value"
    ),
    "q_filter_before_transform": _events(
        "level = 'error' AND value >= 40",
        "line_no, timestamp, upper(level) AS level, source, message, value * 0.5 AS value",
    ),
    "q_aggregate": _fold(_EVENTS),
    "q_aggregate_empty": f"""SELECT count(*) AS count, '0.0' AS sum, 'Infinity' AS min,
      '-Infinity' AS max, 'NaN' AS avg FROM {_EVENTS} WHERE level = 'no such level'""",
    "q_partials": _PARTIALS,
    "q_merge_partials": _fold(_EVENTS),
    "q_chunks": f"""SELECT (line_no - 1) // 300 AS chunk_id,
      (line_no - 1) // 300 * 300 + 1 AS start_line, count(*) AS size
      FROM {_EVENTS} GROUP BY 1, 2""",
    "q_gather_chunks": f"""SELECT (line_no - 1) // 100 AS chunk_id,
      (line_no - 1) // 100 * 100 + 1 AS start_line, count(*) AS size,
      cast(count(*) FILTER (m = 0) AS integer) AS blank,
      max_by({_line()}, line_no) AS last FROM {_EVENTS} GROUP BY 1, 2""",
    "q_process_chunks": f"SELECT sequence, count, sum, min, max, output FROM {_BATCHES}",
    "q_resequence": f"SELECT sequence, pos, line FROM {_BATCH_LINES}",
    "q_resequence_gap": f"SELECT sequence, pos, line FROM {_BATCH_LINES} WHERE sequence < 3",
    "q_difference": f"""WITH a AS (SELECT {_RECORD} FROM {_DIRTY}),
      b AS (SELECT {_RECORD} FROM {_EVENTS})
      SELECT *, cast(1 AS bigint) AS surplus FROM (FROM a EXCEPT ALL FROM b)
      UNION ALL SELECT *, cast(-1 AS bigint) FROM (FROM b EXCEPT ALL FROM a)""",
    "q_render": f"SELECT line_no, {_line()} AS line FROM {_EVENTS}",
    "q_render_documents": f"SELECT line_no, {_line()} AS line FROM {_DOCUMENTS}",
    "q_formula_guard": f"""SELECT line_no, {_guard('message')} AS guarded, {_line()} AS line
      FROM (SELECT * REPLACE (cast(value AS varchar) AS message) FROM {_CUSTOMERS})""",
    "q_quote": f"SELECT line_no, {_quote('message')} AS quoted FROM {_EVENTS}",
    "q_line_numbers": f"SELECT line_no, cast({_DIRTY_WIDTH} AS integer) AS width FROM {_EVENTS}",
    "q_scan_round_trip": f"SELECT line_no, {_line()} AS line FROM {_EVENTS}",
    "q_gzip_round_trip": f"SELECT line_no, {_line()} AS line FROM {_EVENTS}",
    "q_directory": f"""SELECT 'events' AS folder, s.*, f.* FROM {_SUMMARY.format(keep='true')} s,
        ({_fold(_DIRTY)}) f
      UNION ALL SELECT 'customers', count(*), 0, 0, 0, count(*), {_FOLD.format(v='value')}
        FROM {_CUSTOMERS}""",
    "q_jsonl": _events(columns="timestamp, level, source, message, value"),
    "q_jsonl_line_breaks": f"SELECT {_line()} AS line FROM {_DOCUMENTS}",
    "q_parquet_records": _customers("level = 'BUILDING' AND value >= 0"),
    "q_summary": f"""SELECT * FROM {_SUMMARY.format(keep=_ERROR_CLICK)},
      ({_fold(_DIRTY, _ERROR_CLICK, 'value * 0.5')})""",
    "q_run_summary": f"""SELECT s.*, f.min, f.max, f.sum FROM {_SUMMARY.format(keep=_ERROR_CLICK)} s,
      ({_fold(_DIRTY, _ERROR_CLICK, 'value * 0.5')}) f""",
    "q_run_output": f"""SELECT row_number() OVER (ORDER BY line_no) AS line_no, {_line()} AS line
      FROM {_DIRTY} WHERE {_ERROR_CLICK} AND value >= 20""",
    "q_reconcile": f"""SELECT records AS output_lines, records, records AS count, lines_read,
      cast(0 AS bigint) AS unreconciled FROM {_SUMMARY.format(keep=_SOURCE_KEPT)}""",
    "q_run_no_match": f"SELECT * FROM {_SUMMARY.format(keep='false')}",
    "q_run_sorting_transform": f"""SELECT row_number() OVER (ORDER BY line_no) AS line_no, {_line()} AS line,
      lines_read, filtered_out, records FROM {_DIRTY}, {_SUMMARY.format(keep=_ERROR_CLICK)} WHERE {_ERROR_CLICK}""",
    "q_run_partials": f"""SELECT 'events' AS folder, f.*, true AS keys_are_unique FROM ({_fold(_DIRTY)}) f
      UNION ALL SELECT 'customers', f.*, true FROM ({_fold(_CUSTOMERS)}) f""",
    "q_run_dead_letters": f"""SELECT {_STATUS} AS status, count(*) AS lines, count(*) AS found
      FROM {_EVENTS} WHERE m IN {_BAD} GROUP BY 1""",
    "q_failed_run": """SELECT failure, error, (SELECT count(*) FROM events) AS input_lines,
        (SELECT count(*) FROM customer) AS output_lines
      FROM (VALUES ('malformed', 'MalformedLineError'), ('nan', 'SparkRuntimeException'),
        ('opposite infinities', 'AggregateError'), ('overlap', 'ValueError')) AS t (failure, error)""",
    "q_run_history": f"""SELECT cast(3 AS bigint) AS runs, cast(3 * lines_read AS bigint) AS lines_read,
      cast((SELECT 2 * count(*) FILTER ({_ERROR_CLICK}) + count(*) FILTER (level = 'view')
        FROM {_DIRTY}) AS bigint) AS records,
      cast(3 * malformed AS bigint) AS malformed FROM {_SUMMARY.format(keep='true')}""",
    "q_every_nth": f"SELECT line_no, {_line()} AS line FROM {_EVENTS} WHERE (line_no - 1) % 10 = 0",
    "q_infer_types": """SELECT 'timestamp' AS timestamp, 'string' AS level, 'string' AS source,
      'string' AS message, 'double' AS value""",
    "q_infer_types_dirty": """SELECT 'string' AS timestamp, 'string' AS level, 'string' AS source,
      'string' AS message, 'string' AS value""",
    "q_resume": f"""SELECT {_STATUS} AS status, count(*)
        + CASE WHEN {_STATUS} = 'ok' THEN (SELECT count(*) FROM customer) ELSE 0 END AS lines
      FROM {_EVENTS} GROUP BY {_STATUS}""",
    "q_ingest_lines": f"SELECT {_line('value * 0.5')} AS line FROM {_DIRTY} WHERE level = 'purchase'",
    "q_run_many_files": f"""SELECT row_number() OVER (ORDER BY f, line_no) AS line_no, line
      FROM {_TWO_FOLDERS} WHERE value >= 20""",
    "q_run_file_summary": f"""SELECT 'events' AS folder, s.*, f.*, true AS adds_up
        FROM {_SUMMARY.format(keep=_ERROR_CLICK)} s, (SELECT min(value) AS min, max(value) AS max FROM {_DIRTY} WHERE {_ERROR_CLICK}) f
      UNION ALL SELECT 'customers', count(*), 0, 0, count(*) FILTER (level <> 'BUILDING'),
        count(*) FILTER (level = 'BUILDING'), min(value) FILTER (level = 'BUILDING'),
        max(value) FILTER (level = 'BUILDING'), true FROM {_CUSTOMERS}""",
    "q_first_malformed": """SELECT * FROM (VALUES
        ('early', 'Malformed CSV at line 2: expected 5 columns but found 4'),
        ('late', 'Malformed CSV at line ' || (SELECT count(*) FROM customer) || ': expected 5 columns but found 1'),
        ('none', cast((SELECT count(*) FROM customer) AS varchar)),
        ('all', 'Malformed CSV at line 2: expected 5 columns but found 4')) AS t (input, found)""",
    "q_run_jsonl": _TYPED_RUN,
    "q_run_parquet": _TYPED_RUN,
    "q_publish_faults": """SELECT cast(i AS integer) AS fault, CASE WHEN i < 5 THEN 'the file system is gone' END AS error,
        CASE WHEN i < 5 THEN c ELSE e END AS output_lines, CASE WHEN i < 5 THEN c ELSE e END AS summary_lines,
        cast(CASE WHEN i < 5 THEN 1 ELSE 2 END AS bigint) AS runs
      FROM range(6) t (i), (SELECT count(*) AS c FROM customer), (SELECT count(*) AS e FROM events)""",
    "q_exact_sums": f"""SELECT cast(partitions AS integer) AS partitions, level, 7 * count(*) AS count,
        cast(sum(cast(floor(value * 4) / 4 AS decimal(18,4))) AS double) AS sum
      FROM {_EVENTS}, (VALUES (0), (1), (8), (64)) AS p (partitions) GROUP BY ALL""",
    "q_process_runs": f"""SELECT (line_no - 1) // 50 AS sequence, count(*) FILTER (value >= 200) AS count,
        coalesce(cast(sum(cast({_EIGHTH} AS decimal(18,4))) FILTER (value >= 200) AS double), 0.0) AS sum,
        min({_EIGHTH}) FILTER (value >= 200) AS min, max({_EIGHTH}) FILTER (value >= 200) AS max,
        count(*) FILTER (value >= 200) AS lines,
        min_by({_line(_EIGHTH)}, line_no) FILTER (value >= 200) AS first,
        max_by({_line(_EIGHTH)}, line_no) FILTER (value >= 200) AS last FROM {_EVENTS} GROUP BY 1""",
    "q_resequence_deliveries": f"""SELECT b.sequence, pos, line, call FROM {_BATCH_LINES} b JOIN (
        SELECT sequence, cast(max((sequence * 7 + sequence % 4) % 3) OVER (ORDER BY sequence) AS integer) AS call
        FROM (SELECT DISTINCT (line_no - 1) // 50 AS sequence FROM {_EVENTS})) c ON b.sequence = c.sequence""",
    "q_head_lines": f"""SELECT line_no, cast({_DIRTY_WIDTH} AS integer) AS width, 'timestamp' AS type_of_timestamp,
        'string' AS type_of_level, 'string' AS type_of_source, 'string' AS type_of_message, 'double' AS type_of_value
      FROM {_EVENTS} WHERE line_no <= 40""",
    "q_ingest_numbered": f"""SELECT line_no AS input_no, {_STATUS} AS status, cast({_DIRTY_WIDTH} AS integer) AS width,
        true AS fits FROM {_EVENTS}
      UNION ALL SELECT row_number() OVER (ORDER BY line_no) + (SELECT count(*) FROM events), 'ok',
        cast(length({_line()}) AS integer), true FROM {_CUSTOMERS}""",
    "q_line_ends": f"""SELECT line_end, line FROM {_LINES}, (VALUES ('lf'), ('crlf'), ('cr')) AS t (line_end)""",
    "q_invalid_bytes": f"SELECT message || chr(65533) || '!' AS line FROM {_EVENTS}",
    "q_byte_order_mark": f"""SELECT source, line_no, CASE WHEN line_no = 1 THEN line ELSE chr(65279) || line END AS line
      FROM {_LINES}, (VALUES ('file'), ('memory')) AS t (source)""",
    "q_missing_input": """SELECT failure, true AS failed, (SELECT count(*) FROM events) AS output_lines,
        (SELECT count(*) FROM customer) AS input_lines
      FROM (VALUES ('no input'), ('output below a file')) AS t (failure)""",
    "q_long_fields": f"""WITH long AS (SELECT line_no, message, row_number() OVER (ORDER BY length(message) DESC, line_no DESC) AS n
        FROM {_DOCUMENTS} WHERE length(message) >= 1000),
      longer AS (SELECT line_no, repeat(message, cast(CASE WHEN n = 1 THEN ceil(10485760 / length(message)) ELSE 1 END AS bigint)) AS message FROM long)
      SELECT line_no, cast(length(message) AS integer) AS width, md5(message) AS digest
      FROM (SELECT line_no, {_TRIM.format(x=f"({_guard('message')})")} AS message FROM longer)""",
    "q_identity": _events(),
    "q_count_overflow": """SELECT * FROM (VALUES ('fits', '9223372036854775806'), ('overflows', 'overflow')) AS t ("case", found)""",
    "q_control_characters": f"SELECT line_no, ' ' || message || '    ' || level AS plain FROM {_EVENTS}",
    "q_throughput": f"""SELECT s.*, f.min, f.max, true AS fits FROM {_SUMMARY.format(keep='true')} s, ({_fold(_DIRTY)}) f""",
}
