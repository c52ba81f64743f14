"""The SQL twins of the catalogue, for an engine other than Spark to run on the same tables."""

from __future__ import annotations

# All that the twins need is written out here, so that no fault of the code under test is shared.
# The key of the views, chart types with the column that each plots, and labels of the stages.
_KEY = b"fixture_key".ljust(64, b"\0")
_INNER, _OUTER = (bytes(b ^ pad for b in _KEY).hex() for pad in (0x36, 0x5C))
_CHARTS = {
    "real_time_line_graph_values": "metric_value",
    "real_time_line_graph_average": "computed_metric",
    "real_time_bar_chart_values": "metric_value",
    "real_time_bar_chart_average": "computed_metric",
    "real_time_scatter_values": "metric_value",
    "real_time_scatter_average": "computed_metric",
}
_STAGES = {
    "raw": "Raw Stream (Input → Core)",
    "intermediate": "Intermediate Stream (Core → Aggregator)",
    "processed": "Processed Stream (Aggregator → Output)",
}


def _hmac(message: str) -> str:
    return f"sha256(unhex('{_OUTER}') || unhex(sha256(unhex('{_INNER}') || {message})))"


_ONE = _hmac("encode(printf('%.2f', value)) || unhex('00000001')")

SIGNALS = f"""
signed as (select event_id, event_type as entity_name, cast(floor(epoch(ts)) as bigint) as time_period,
  value as metric_value, {_ONE} as digest from events),
signals as (select event_id, entity_name, time_period, metric_value, digest,
  case when event_id % 7 = 3 then reverse(digest) else digest end as security_hash from signed)"""

NUMBERED = SIGNALS + """,
numbered as (select row_number() over (order by event_id) as priority_index, * from signals),
verified as (select priority_index, entity_name, time_period, metric_value, security_hash
  from numbered where digest = security_hash)"""


def _mean(value: str, window: str) -> str:
    """The mean of values of whole cents: their exact sum, divided once, rounded as Python does."""
    cents = f"(sum(cast(round({value} * 100) as hugeint)) over ({window}))::double"
    return f"cast(printf('%.4f', {cents} / 100 / count({value}) over ({window})) as double)"


def _processed(window: int) -> str:
    frame = f"order by priority_index rows between {window - 1} preceding and current row"
    return NUMBERED + f""",
processed as (select *, {_mean("metric_value", frame)} as computed_metric from verified)"""


RAW = SIGNALS + """,
marked as (select *, case when event_id % 17 = 0 then 17 when event_id % 19 = 0 then 19
  when event_id % 23 = 0 then 23 when event_id % 29 = 0 then 29 when event_id % 31 = 0 then 31
  else 0 end as m from signals),
raw_signals as (select event_id,
  case when m = 29 then '' else entity_name end as entity,
  case when m = 23 then '12.7' else cast(time_period as varchar) end as epoch,
  case when m = 17 then 'N/A' when m = 19 then '12x'
    when m = 31 then '  ' || cast(metric_value as varchar) || ' '
    else cast(metric_value as varchar) end as reading,
  security_hash as signature from marked),
cells as (select event_id, nullif(entity, '') as entity, epoch,
  nullif(reading, 'N/A') as reading, signature from raw_signals),
casts as (select *, trim(entity) as c1,
  case when regexp_full_match(trim(epoch), '[+-]?[0-9]+') then try_cast(trim(epoch) as bigint) end as c2,
  try_cast(trim(reading) as double) as c3, trim(signature) as c4 from cells),
clean as (select * from casts where c1 is not null and c2 is not null and c3 is not null
  and c4 is not null),
bad as (select row_number() over (order by event_id) - 1 as row_index, * from casts),
quarantined as (select row_index,
  case when c1 is null then 'entity' when c2 is null then 'epoch' when c3 is null then 'reading'
    else 'signature' end as "column",
  case when c1 is null then entity when c2 is null then epoch when c3 is null then reading
    else signature end as raw_value,
  case when c1 is null then 'string' when c2 is null then 'integer' when c3 is null then 'float'
    else 'string' end as t
  from bad where c1 is null or c2 is null or c3 is null or c4 is null),
quarantine as (select row_index, "column", raw_value,
  'Cannot cast ''' || coalesce(raw_value, 'nan') || ''' to ' || t as reason from quarantined)"""

RAW_PROCESSED = RAW + """,
r_numbered as (select row_number() over (order by event_id) as priority_index, *,
  sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode(printf('%.2f', c3))
    || unhex('00000001')))) as digest from clean),
r_processed as (select priority_index, c1 as entity_name, c2 as time_period, c3 as metric_value,
  c4 as security_hash, {mean} as computed_metric from r_numbered where digest = c4)""".format(
    inner=_INNER, outer=_OUTER, mean=_mean("c3", "order by priority_index rows between 9 preceding and current row")
)

def _feed(table: str) -> str:
    """The last 120 points per chart of the processed rows in ``table``."""
    feeds = " union all ".join(
        f"select '{kind}: {kind.replace('_', ' ')}' as chart, priority_index, cast(time_period as double) as x,"
        f" cast(time_period as varchar) as x_text, {plotted} as y from {table}"
        for kind, plotted in _CHARTS.items()
    )
    return f""",
points as ({feeds}),
ranked as (select *, row_number() over (partition by chart order by priority_index desc) as r from points),
feed as (select chart, row_number() over (partition by chart order by priority_index) - 1 as position,
  x, x_text, y from ranked where r <= 120)"""


FEED = _processed(10) + _feed("processed")

_SAMPLES = """counts as (select cast(floor(floor(epoch(ts)) / 3600) as bigint) as sample, count(*) as raw,
  count(*) filter (event_type = 'click') as intermediate,
  count(*) filter (event_type = 'error') as processed from events group by 1),
samples as (
  select sample, 'raw' as stage, raw as size, cast(20 as bigint) as max from counts
  union all select sample, 'intermediate', intermediate, 20 from counts
  union all select sample, 'processed', processed, 20 from counts)"""


def _health(size: str, extra: str = "") -> str:
    labels = " ".join(f"when '{s}' then '{text}'" for s, text in _STAGES.items())
    return f"""with {_SAMPLES},
filled as (select sample, stage, {size} as size, max, least({size} / max, 1.0::double) as fill_ratio
  from samples)
select sample, stage, size, max, fill_ratio, cast(floor(fill_ratio * 100) as int) as percent,
  case when fill_ratio < 0.40 then 'green' when fill_ratio < 0.75 then 'yellow' else 'red' end as color,
  case stage {labels} end as label{extra} from filled"""


_ARRIVALS = """arrivals as (select event_id, cast(floor(epoch(ts)) as bigint)
  + case when event_id % 13 = 0 then 3600 else 0 end as arrival, event_type from events),
flagged as (select *, coalesce(arrival - min(arrival) over (order by event_id
  rows between 1 following and unbounded following) > 2, false) as late from arrivals)"""

# Lines that end in a cell too many, and lines with a quote that is not closed in them.
_TORN = """with torn as (
  select 'RAGGED_ROW' as code, 'Could not read CSV: lines with too many cells: ' as text,
    count(*) filter (event_id % 100 = 7) as n from events
  union all select 'OPEN_QUOTE', 'Could not read CSV: lines that leave a quote open: ',
    count(*) filter (event_id % 200 = 9) from events)
"""

# Batch b has the numbers with rest b by five. At the second batch all gaps below the last multiple of five
# have timed out; what comes later is late, unless it lies beyond that.
_LANDED = """placed as (select *, priority_index % 5 >= 2 and priority_index < (select max(priority_index) // 5 * 5
  from numbered) as late from numbered)"""


_SECOND = _hmac("unhex(u1)")

_VERIFIED_COLUMNS = "priority_index, entity_name, time_period, metric_value, security_hash"
_SIGNAL_COLUMNS = "event_id, entity_name, time_period, metric_value, security_hash"
_PROCESSED_COLUMNS = _VERIFIED_COLUMNS + ", computed_metric"


def oracle_sql() -> dict[str, str]:
    rolling = {
        f"rolling_average_w{w}": f"with {_processed(w)} select {_PROCESSED_COLUMNS} from processed"
        for w in (1, 3, 10, 100, 5000)
    }
    verified = f"with {SIGNALS} select {_SIGNAL_COLUMNS} from signals where digest = security_hash"
    renames = "entity as entity_name, epoch as time_period, reading as metric_value, signature as security_hash"
    return rolling | {
        "flagship": rolling["rolling_average_w10"],
        "stream_rolling_average": rolling["rolling_average_w10"],
        "stream_drain": f"""with {NUMBERED}, arrived as (select * from verified
              where priority_index % 400 <> 77)
            select {_VERIFIED_COLUMNS},
              {_mean("metric_value", "order by priority_index rows between 9 preceding and current row")} as computed_metric
            from arrived""",
        "stream_resequence": f"with {NUMBERED} select {_VERIFIED_COLUMNS} from numbered",
        "stream_verify": f"with {NUMBERED} select {_VERIFIED_COLUMNS} from verified",
        "write_processed": f"with {RAW_PROCESSED} select {_PROCESSED_COLUMNS} from r_processed",
        "write_feed": f"with {FEED} select * from feed",
        "end_to_end_quarantine": f"with {RAW} select * from quarantine",
        "end_to_end_feed": f"with {RAW_PROCESSED}{_feed('r_processed')} select * from feed",
        "end_to_end_gaps": f"with {RAW_PROCESSED} select priority_index as missing from r_numbered "
        "where digest <> c4",
        "cast_declared": f"with {RAW} select event_id, c1 as entity_name, c2 as time_period, "
        "c3 as metric_value, c4 as security_hash from clean",
        "quarantine_rows": f"with {RAW} select * from quarantine",
        "quarantine_preview": f"""with {RAW}
            select row_index, "column", substr(coalesce(raw_value, 'nan'), 1, 18) as raw_value,
              substr(reason, 1, 40) as reason,
              greatest((select count(*) from quarantine) - 6, 0) as more
            from quarantine order by row_index limit 6""",
        "ingest_summary": f"""with {RAW}
            select (select count(*) from casts) as loaded, (select count(*) from clean) as passed,
              (select count(*) from quarantine) as skipped""",
        "dataset_status": f"""with {RAW}, n as (select count(*) as skipped from quarantine)
            select case when skipped > 0 then 'AMBER' else 'GREEN' end as status,
              cast(0 as bigint) as fatal, skipped, true as may_run from n""",
        "select_rename": f"with {RAW} select event_id, {renames} from raw_signals",
        "as_records": f"with {NUMBERED} select {_VERIFIED_COLUMNS} from numbered",
        "as_json_records": f"""with {RAW} select '{{"event_id":' || event_id || ',"entity":"' || entity ||
            '","epoch":"' || epoch || '","reading":"' || reading || '","signature":"' || signature || '"}}'
            as record from raw_signals""",
        "dataset_status_cases": f"""with {RAW}, n as (select count(*) as bad from quarantine)
            select 'missing column' as "case", 'RED' as status, cast(1 as bigint) as fatal, bad as skipped,
              false as may_run from n
            union all select 'bad rows', case when bad > 0 then 'AMBER' else 'GREEN' end, 0, bad, true from n
            union all select 'clean rows', 'GREEN', 0, 0, true from n""",
        "check_columns": """select * from (values
              ('FATAL', 'MISSING_COLUMN', 'reading',
                'Column ''reading'' declared in config schema_mapping but missing from CSV.'),
              ('INFO', 'EXTRA_COLUMN', 'event_id', 'Ignoring extra CSV column: ''event_id'''))
            as t(severity, code, "column", message), (select count(*) as rows from events)""",
        "scan_errors": _TORN + """select 'FATAL' as severity, code, cast(null as varchar) as "column",
            text || n as message from torn where n > 0""",
        "error_preview": _TORN + """select code, cast(null as varchar) as "column",
            substr(text || n, 1, 90) as message from torn where n > 0""",
        "chart_titles": f"""with {NUMBERED} select unnest(['real_time_line_graph_values: readings',
              'real_time_line_graph_values: readings (2)', 'real_time_line_graph_values: readings (3)']) as chart,
            'readings  ✔ Complete' as title from (select count(*) from verified)""",
        "chart_feed_twins": f"""with {_processed(10)},
            points as (
              select 'real_time_line_graph_values: readings' as chart, priority_index as n, time_period as t,
                metric_value from processed
              union all select 'real_time_line_graph_values: readings (2)', priority_index, priority_index,
                metric_value from processed
              union all select 'real_time_line_graph_values: readings (3)', priority_index, time_period,
                metric_value from processed),
            ranked as (select *, row_number() over (partition by chart order by n desc) as r from points)
            select chart, row_number() over (partition by chart order by n) - 1 as position,
              cast(t as double) as x, cast(t as varchar) as x_text, metric_value as y from ranked where r <= 120""",
        "bar_labels": f"""with {FEED}, n as (select *, count(*) over (partition by chart) as n from feed)
            select chart, position, right(x_text, 4) as label from n
            where position % greatest(1, n // 6) = 0 and starts_with(chart, 'real_time_bar_chart')""",
        "scatter_extents": f"""with {FEED}, e as (select chart, min(x) as x0, max(x) as x1,
              min(y) as y0, max(y) as y1 from feed where starts_with(chart, 'real_time_scatter') group by chart),
            p as (select *, case when (x1 - x0) * 0.05 = 0 then 1 else (x1 - x0) * 0.05 end as px,
              case when (y1 - y0) * 0.05 = 0 then 1 else (y1 - y0) * 0.05 end as py from e)
            select chart, x0 - px as x_low, y0 - py as y_low, x1 + px as x_high, y1 + py as y_high
            from p""",
        "stream_csv": f"with {RAW} select c1 as entity_name, c2 as time_period, c3 as metric_value, "
        "c4 as security_hash from clean",
        "stream_no_sequence": f"""with {NUMBERED} select cast(null as bigint) as priority_index, entity_name,
            time_period, metric_value, security_hash from numbered where priority_index % 50 = 7""",
        "stream_gap_timeout": f"with {NUMBERED}, {_LANDED} select {_VERIFIED_COLUMNS} from placed where not late",
        "stream_late_rows": f"with {NUMBERED}, {_LANDED} select {_VERIFIED_COLUMNS} from placed where late",
        "stream_repeated": f"with {NUMBERED} select {_VERIFIED_COLUMNS} from numbered where priority_index % 11 = 3",
        "stream_release_samples": f"""with {NUMBERED}, {_LANDED},
            raw as (select priority_index % 5 as sample, count(*) as size, count(*) filter (not late) as out
              from placed group by 1)
            select sample, 'raw' as stage, size from raw
            union all select sample, 'intermediate', case when sample = 0 then size else 0 end from raw
            union all select sample, 'processed', case sample when 0 then 0
              when 1 then out + (select size from raw where sample = 0) else out end from raw""",
        "progress_samples": f"""with {NUMBERED},
            n as (select priority_index % 5 as sample, count(*) as read, count(*) filter (digest = security_hash) as kept
              from numbered group by 1)
            select sample, unnest(['raw', 'intermediate', 'processed']) as stage, unnest([read, 0, kept]) as size from n""",
        "stream_end_to_end": f"with {RAW_PROCESSED} select {_PROCESSED_COLUMNS} from r_processed",
        "stream_end_to_end_quarantine": f"with {RAW} select * from quarantine",
        "stream_end_to_end_feed": f"with {RAW_PROCESSED}{_feed('r_processed')} select * from feed",
        "stream_add_sequence": f"""with {RAW} select row_number() over (order by event_id) as priority_index,
            c1 as entity_name, c2 as time_period, c3 as metric_value, c4 as security_hash from clean""",
        "stream_scan_errors": _TORN + """select 'FATAL' as severity, code, cast(null as varchar) as "column",
            text || n as message from torn where n > 0""",
        "stream_by_entity": f"""with {SIGNALS} select event_id, entity_name,
            {_mean("metric_value", "partition by entity_name order by event_id rows between 9 preceding and current row")}
            as computed_metric from signals""",
        "stream_by_entity_drain": f"""with {SIGNALS}, n as (select *,
              row_number() over (partition by entity_name order by event_id) as n from signals),
            came as (select * from n where n % 400 <> 77)
            select event_id, entity_name,
            {_mean("metric_value", "partition by entity_name order by event_id rows between 9 preceding and current row")}
            as computed_metric from came""",
        "stream_verify_table": f"with {NUMBERED} select {_VERIFIED_COLUMNS} from verified",
        "stream_faults": """select case when event_id % 100 = 7 then 'RAGGED_ROW' when event_id % 200 = 9 then 'OPEN_QUOTE'
              else 'NONE' end as code, count(*) as lines from events group by 1""",
        "scan_csv": f"""with {RAW} select row_number() over (order by event_id) as priority_index,
            c1 as entity_name, c2 as time_period, c3 as metric_value, c4 as security_hash from clean""",
        "add_sequence": "select row_number() over (order by ts, event_id) as priority_index, "
        "ts, event_id, value from events",
        "verify_signatures": verified,
        "verify_signatures_udf": verified,
        "verify_signatures_wide": verified,
        "verify_signatures_table": f"""with u as (select event_id, value, {_ONE} as u1 from events),
            uu as (select *, {_SECOND} as u2 from u),
            d as (select event_id, value as metric_value,
              lower(hex(cast(xor(cast(unhex(u1) as bit), cast(unhex(u2) as bit)) as blob)))
              as security_hash from uu)
            select * from d where event_id % 7 <> 3""",
        "verification_summary": f"""with {SIGNALS} select entity_name,
            count(*) filter (digest = security_hash) as verified,
            count(*) filter (digest <> security_hash) as dropped from signals group by entity_name""",
        "resequence": f"with {NUMBERED} select row_number() over (order by priority_index) "
        f"as position, {_VERIFIED_COLUMNS} from verified",
        "find_gaps": f"""with {NUMBERED}, n as (select unnest(range(1,
              (select max(priority_index) from verified) + 1)) as missing)
            select missing from n anti join verified on missing = priority_index""",
        "gap_ranges": f"""with {NUMBERED}, ends as (select coalesce(lag(priority_index) over (order by priority_index), 0) + 1
              as first, priority_index - 1 as last from verified)
            select first, last from ends where first <= last""",
        "reject_stale": f"with {_ARRIVALS} select event_id, arrival, event_type from flagged where not late",
        "stale_flags": f"with {_ARRIVALS} select event_id, late from flagged",
        "rolling_average_by_entity": f"""with {SIGNALS} select event_id, entity_name,
            {_mean("metric_value", "partition by entity_name order by event_id rows between 9 preceding and current row")}
            as computed_metric from signals""",
        "chart_feed": f"with {FEED} select * from feed",
        "chart_extents": f"""with {FEED}, e as (select chart, min(x) as x0, max(x) as x1,
              min(y) as y0, max(y) as y1 from feed group by chart),
            p as (select *, case when (x1 - x0) * 0.05 = 0 then 1 else (x1 - x0) * 0.05 end as px,
              case when (y1 - y0) * 0.05 = 0 then 1 else (y1 - y0) * 0.05 end as py from e)
            select chart, x0 - px as x_low, y0 - py as y_low, x1 + px as x_high, y1 + py as y_high
            from p""",
        "axis_labels": f"""with {FEED}, n as (select *, count(*) over (partition by chart) as n from feed)
            select chart, position, right(x_text, 4) as label from n
            where position % greatest(1, n // 6) = 0""",
        "float_axis_labels": f"""with {NUMBERED}, r as (select metric_value, row_number() over (order by priority_index desc) as r
              from verified),
            f as (select metric_value, row_number() over (order by r desc) - 1 as position, count(*) over () as n
              from r where r <= 120)
            select 'real_time_scatter_values: by value' as chart, position, right(cast(metric_value as varchar), 4) as label
            from f where position % greatest(1, n // 6) = 0""",
        "stage_health": _health("size"),
        "stage_health_hidden": _health(
            "case when stage = 'intermediate' then 0 else size end", ", stage <> 'intermediate' as shown"
        ),
        "processed_summary": f"with {NUMBERED} select count(*) as processed, true as complete from verified",
        "end_to_end": f"with {RAW_PROCESSED} select {_PROCESSED_COLUMNS} from r_processed",
    }
