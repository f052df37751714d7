"""DuckDB twins of the registered queries, written apart from them.

They start from the given tables, count each event type on its own and join the four counts,
and say which messages are good by the rules that made them rather than by parsing JSON.
Amounts are rounded like in the queries (see ``registry.rounded``).
"""

from __future__ import annotations

FIRST_LOAD = "TIMESTAMP '2024-01-20 07:30:00'"

_CTES = {
    "tracking_digits": """
        select event_id, ts as event_ts, user_id, value, event_type,
          cast(json_extract_string(props, '$.k') as int) as k,
          lpad(printf('%x', epoch_us(ts) * 10 + 122192928000000000), 16, '0') as h
        from events""",
    "tracking": """
        select event_id, event_ts,
          substr(h, 9, 8) || '-' || substr(h, 5, 4) || '-1' || substr(h, 2, 3) || '-8000-'
            || lpad(printf('%x', event_id), 12, '0') as create_time,
          case when event_id % 97 = 0 then null
            else cast(if(event_id % 3 = 0, 1, event_id * 16 // 100) as double)
              + case when event_id % 211 = 0 then 0.5 when event_id % 223 = 0 then 3e9 else 0 end
            end as job_id,
          cast(case when event_id % 53 = 0 then null when event_id % 3 = 0 then k % 2
            else event_id * 11 // 1000 end as double) as publisher_id,
          cast(case when event_id % 41 = 0 then null when event_id % 3 = 0 then user_id % 3
            else event_id * 21 // 100 end as double) as campaign_id,
          cast(case when event_id % 31 = 0 then null when event_id % 3 = 0 then user_id % 2
            else event_id % 6 end as double) as group_id,
          case when event_id % 29 = 0 then null else value end as bid,
          case event_type when 'purchase' then 'conversion' when 'signup' then 'qualified'
            when 'error' then 'unqualified' else event_type end as custom_track,
          strftime(event_ts, '%Y-%m-%d %H:%M:%S') as ts_text,
          'b' || (user_id % 4) as bn, cast(event_id % 7 as double) as cd
        from tracking_digits""",
    "decoded": """
        select *, make_timestamp((('0x' || substr(create_time, 16, 3) || substr(create_time, 10, 4)
          || substr(create_time, 1, 8))::bigint - 122192928000000000) // 10) as ts
        from tracking""",
    "clean": """
        select create_time, custom_track, ts, event_ts,
          case when isnan(job_id) then 0 else job_id end as job_id,
          case when publisher_id is null or isnan(publisher_id) then 0 else publisher_id end
            as publisher_id,
          case when campaign_id is null or isnan(campaign_id) then 0 else campaign_id end
            as campaign_id,
          case when group_id is null or isnan(group_id) then 0 else group_id end as group_id,
          case when custom_track = 'click' and (bid is null or isnan(bid)) then 0 else bid end
            as bid,
          cast(ts as date) as date, cast(extract(hour from ts) as int) as hour
        from decoded where job_id is not null""",
    "job": """
        select cast(c_custkey + 1 as int) as id, cast(c_nationkey as int) as company_id,
          cast(case when c_custkey % 7 = 4 then null else (c_custkey + c_nationkey) % 2 end as int)
            as group_id,
          cast(c_custkey % 3 as int) as campaign_id
        from customer""",
    "messages": """
        select t.* replace (bid + copy as bid,
            case when event_id % 107 = 0 then substr(create_time, 1, 14) || '4'
              || substr(create_time, 16) else create_time end as create_time),
          copy, event_id * 2 + copy as "offset",
          case when event_id % 101 = 0 then 'malformed_json'
            when event_id % 103 = 0 then 'not_numeric'
            when event_id % 107 = 0 then 'bad_create_time' end as reject_reason
        from tracking t, (values (0), (1)) as c(copy)
        where copy = 0 or event_id % 10 = 0""",
}

_CELL = "job_id, date, hour, publisher_id, campaign_id, group_id"
_MESSAGE = "create_time, bid, campaign_id, custom_track, group_id, job_id, publisher_id"


def _metrics_ctes(source: str = "clean") -> dict[str, str]:
    def count(event_type: str, name: str) -> str:
        return (
            f"select {_CELL}, count(*) as {name}, max(ts) as {name}_ts from {source} "
            f"where custom_track = '{event_type}' group by {_CELL}"
        )

    return {
        "click_cells": f"""
            select {_CELL}, avg(bid) as bid_set, count(*) as clicks, sum(bid) as spend_hour,
              max(ts) as clicks_ts
            from {source} where custom_track = 'click' group by {_CELL}""",
        "conversion_cells": count("conversion", "conversions"),
        "qualified_cells": count("qualified", "qualified"),
        "unqualified_cells": count("unqualified", "unqualified"),
        "cells": f"""
            select {_CELL}, bid_set, clicks, spend_hour, conversions, qualified, unqualified,
              greatest(clicks_ts, conversions_ts, qualified_ts, unqualified_ts) as last_ts
            from click_cells full join conversion_cells using ({_CELL})
              full join qualified_cells using ({_CELL})
              full join unqualified_cells using ({_CELL})""",
    }


_FACT = {
    "fact": """
        select cast(c.job_id as bigint) as job_id, c.date as dates, c.hour as hours,
          cast(c.publisher_id as bigint) as publisher_id, cast(j.company_id as bigint) as company_id,
          cast(c.campaign_id as bigint) as campaign_id, cast(c.group_id as bigint) as group_id,
          unqualified as disqualified_application, qualified as qualified_application,
          conversions as conversion, clicks, round(bid_set + 1e-9, 4) as bid_set,
          round(spend_hour + 1e-9, 4) as spend_hour, 'Cassandra' as sources, spend_hour as exact_spend,
          last_ts
        from cells c left join job j on j.id = c.job_id
        where c.job_id = floor(c.job_id)""",
}
_FACT_COLUMNS = (
    "job_id, dates, hours, publisher_id, company_id, campaign_id, group_id, "
    "disqualified_application, qualified_application, conversion, clicks, bid_set, spend_hour, "
    "sources"
)
_SURROGATE = {
    "bucketed": """
        select *, ('0x' || substr(md5(concat_ws('|', job_id, publisher_id, campaign_id, group_id)),
          1, 2))::bigint as bucket
        from fact""",
    "numbered": """
        select *, (datediff('day', date '1970-01-01', dates) * 24 + hours) * 100000000000
          + (row_number() over (partition by dates, hours, bucket
             order by job_id, publisher_id, campaign_id, group_id) - 1) * 256 + bucket + 1 as id
        from bucketed""",
}


_ALL_CELLS = f"""
    select {_CELL}, round(bid_set + 1e-9, 4) as bid_set, clicks, round(spend_hour + 1e-9, 4) as spend_hour,
      conversions, qualified, unqualified
    from cells"""


def _with(select: str, *names: str, **more: str) -> str:
    ctes = {n: _CTES[n] for n in names} | more
    return "with " + ",\n".join(f"{n} as ({body})" for n, body in ctes.items()) + "\n" + select


_BASE = ("tracking_digits", "tracking")
_EVENTS = (*_BASE, "decoded")
_CLEAN = (*_EVENTS, "clean")
_SENT = (*_BASE, "messages")


def _on_cells(select: str) -> str:
    return _with(select, *_CLEAN, **_metrics_ctes())


def _on_fact(select: str, **more: str) -> str:
    return _with(select, *_CLEAN, "job", **_metrics_ctes(), **_FACT, **more)


def _on_loaded_fact(select: str) -> str:
    before = {"before": f"select * from clean where event_ts <= {FIRST_LOAD}"}
    return _with(select, *_CLEAN, "job", **before, **_metrics_ctes("before"), **_FACT)


_SUMS = (
    "cast(coalesce(sum(clicks), 0) as bigint) as clicks, "
    "cast(coalesce(sum(conversion), 0) as bigint) as conversion, "
    "cast(coalesce(sum(qualified_application), 0) as bigint) as qualified_application, "
    "cast(coalesce(sum(disqualified_application), 0) as bigint) as disqualified_application"
)
_SPEND = (
    "round(coalesce(sum(exact_spend), 0) + 1e-9, 4) as spend, "
    "round(sum(exact_spend) / nullif(sum(clicks), 0) + 1e-9, 4) as bid_set"
)


def _daily(key: str) -> str:
    return _on_fact(f"select {key}, dates, {_SUMS}, {_SPEND} from fact group by {key}, dates")


def _funnel(key: str) -> str:
    return _on_fact(f"""
        select {key}, {_SUMS},
          round(coalesce(sum(conversion), 0)::double / nullif(sum(clicks), 0) + 1e-9, 4) as conversion_rate,
          round(coalesce(sum(qualified_application), 0)::double
            / nullif(coalesce(sum(qualified_application), 0)
              + coalesce(sum(disqualified_application), 0), 0) + 1e-9, 4) as qualified_share,
          round(coalesce(sum(exact_spend), 0) / nullif(sum(conversion), 0) + 1e-9, 4)
            as spend_per_conversion
        from fact group by {key}""")


def _by_dimension(key: str, dimension: str, dimension_key: str, source: str, name: str) -> str:
    return _on_fact(f"""
        select f.{key}, {_SUMS}, {_SPEND}, any_value(d.{source}) as {name}
        from fact f left join {dimension} d on d.{dimension_key} = f.{key}
        group by f.{key}""")


def _latest(more: str = "") -> str:
    """The last version of each key among the good messages."""
    return _with(
        f"""
        select {_MESSAGE}, ts_text as ts {more} from messages m
        where reject_reason is null and not exists (
          select 1 from messages l where l.create_time = m.create_time
            and l.reject_reason is null and l."offset" > m."offset")""",
        *_SENT,
    )


def _on_last_sent(select: str) -> str:
    """On the cells, or the fact, of the last good version of each key."""
    last = {
        "last_sent": """
            select * from messages m where reject_reason is null and not exists (
              select 1 from messages l where l.create_time = m.create_time
                and l.reject_reason is null and l."offset" > m."offset")""",
        "decoded": _CTES["decoded"].replace("from tracking", "from last_sent"),
        "clean": _CTES["clean"],
        "job": _CTES["job"],
    }
    return _with(select, *_SENT, **last, **_metrics_ctes(), **_FACT)


# Which messages came in which of eight batches, and the clock that each batch was judged by.
_GATE = {
    "received": """
        select *, event_ts + to_hours(cast(copy + case when event_id % 109 = 0 then -2 when event_id % 113 = 0 then 5
          else 0 end as bigint)) as received_at from messages""",
    "waves": """
        select *, (epoch_us(received_at) - (select min(epoch_us(received_at)) from received)) * 8
          // ((select max(epoch_us(received_at)) - min(epoch_us(received_at)) + 1 from received)) as wave
        from received""",
    "good": "select * from waves where reject_reason is null",
    "clocks": """
        select w.wave, coalesce(max(g.event_ts) - interval 1 hour, timestamp '1990-01-01') as clock
        from (select distinct wave from waves) w left join good g on g.wave < w.wave group by w.wave""",
    "judged": """
        select g.*, clock, date_trunc('hour', event_ts) + interval 1 hour <= clock as late
        from good g join clocks using (wave)""",
}


def _on_open_hours(select: str) -> str:
    """On the cells of the last version of each key among the messages that were not late."""
    passed = {
        "last_sent": """
            select * from judged m where not late and not exists (
              select 1 from judged l where l.create_time = m.create_time and not l.late and l."offset" > m."offset")""",
        "decoded": _CTES["decoded"].replace("from tracking", "from last_sent"),
        "clean": _CTES["clean"],
    }
    return _with(select, *_SENT, **_GATE, **passed, **_metrics_ctes())


def oracle_sql() -> dict[str, str]:
    newest = "(select max(ts) from decoded)"
    return {
        "tracking_scan": _with(
            "select create_time, job_id, custom_track, bid, campaign_id, group_id, publisher_id "
            "from tracking", *_BASE),
        "latest_event_time": _with("select max(ts) as max_ts from decoded", *_EVENTS),
        "job_dim": _with("select id as job_id, company_id, group_id, campaign_id from job", "job"),
        "publisher_ids": "select distinct cast(s_suppkey as int) as publisher_id from supplier",
        "group_ids": _with("select group_id from job where group_id is not null", "job"),
        "csv_load": _with(f"select {_MESSAGE}, ts_text as ts from tracking", *_BASE),
        "tracking_summary": _with(
            "select create_time, bid, bn, cast(campaign_id as int) as campaign_id, "
            "cast(cd as int) as cd from tracking", *_BASE),
        "encoded_events": _with("select event_id, create_time from tracking", *_BASE),
        "decoded_events": _with("select create_time, event_ts as ts from tracking", *_BASE),
        "event_text_time": _with(
            "select create_time, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts_text, "
            "date_trunc('second', ts) as ts_second from decoded", *_EVENTS),
        "weighted_types": """
            select event_id, case when draw < 70 then 'click' when draw < 80 then 'conversion'
              when draw < 90 then 'qualified' else 'unqualified' end as custom_track
            from (select event_id, (event_id * 37 + 11) % 100 as draw from events)""",
        "assigned_publisher": """
            with numbered as (
              select cast(s_suppkey as int) as publisher_id,
                row_number() over (order by substr(md5(s_suppkey::varchar), 1, 2), s_suppkey) - 1
                  as n
              from supplier)
            select event_id, cast(event_id % 2 as double) as bid, publisher_id
            from events left join numbered on n = event_id % (select count(*) from supplier)""",
        "tracking_clean": _with(
            "select create_time, job_id, custom_track, bid, campaign_id, group_id, publisher_id, "
            "ts from clean", *_CLEAN),
        "events_by_type": _with(
            "select custom_track, count(*) as events from tracking where custom_track in "
            "('click', 'conversion', 'qualified', 'unqualified') group by 1", *_BASE),
        "hourly_clicks": _on_cells(
            f"select {_CELL}, round(bid_set + 1e-9, 4) as bid_set, clicks, "
            "round(spend_hour + 1e-9, 4) as spend_hour from click_cells"),
        "hourly_conversions": _on_cells(f"select {_CELL}, conversions from conversion_cells"),
        "hourly_qualified": _on_cells(f"select {_CELL}, qualified from qualified_cells"),
        "hourly_unqualified": _on_cells(f"select {_CELL}, unqualified from unqualified_cells"),
        "hourly_metrics": _on_cells(_ALL_CELLS),
        "hourly_metrics_joined": _with(f"""
            select {_CELL},
              round(sum(bid) filter (custom_track = 'click')
                / nullif(count(*) filter (custom_track = 'click'), 0) + 1e-9, 4) as bid_set,
              nullif(count(*) filter (custom_track = 'click'), 0) as clicks,
              round(sum(bid) filter (custom_track = 'click') + 1e-9, 4) as spend_hour,
              nullif(count(*) filter (custom_track = 'conversion'), 0) as conversions,
              nullif(count(*) filter (custom_track = 'qualified'), 0) as qualified,
              nullif(count(*) filter (custom_track = 'unqualified'), 0) as unqualified
            from clean
            where custom_track in ('click', 'conversion', 'qualified', 'unqualified')
            group by {_CELL}""", *_CLEAN),
        "stream_hourly_metrics": _on_last_sent(_ALL_CELLS),
        "fact": _on_fact(f"select {_FACT_COLUMNS} from fact"),
        "fact_with_surrogate": _on_fact(
            f"select id, {_FACT_COLUMNS} from numbered", **_SURROGATE),
        "incremental_load": _on_fact(f"select id, {_FACT_COLUMNS} from numbered", **_SURROGATE),
        "incremental_rows": _with(
            f"select create_time, ts from decoded where ts > {FIRST_LOAD}", *_EVENTS),
        "fact_watermark": _on_fact(
            "select date_trunc('second', coalesce(max(last_ts), timestamp '1998-01-01')) as max_ts "
            "from fact"),
        "gate_load_time": _on_loaded_fact(f"""
            select newest_event_ts, watermark, newest_event_ts > watermark as has_new from (
              select {newest} as newest_event_ts, date_trunc('second',
                coalesce(max(last_ts), timestamp '1998-01-01')) as watermark from fact)"""),
        "gate_event_time": _with(f"""
            select newest_event_ts, watermark, newest_event_ts > watermark as has_new from (
              select max(ts) as newest_event_ts,
                max(ts) filter (event_ts <= {FIRST_LOAD}) as watermark from decoded)""",
            *_EVENTS),
        "fact_latest": _on_fact(
            f"select {_FACT_COLUMNS.removesuffix(', sources')} from fact order by dates desc, "
            "hours desc, job_id, publisher_id, campaign_id, group_id limit 20"),
        "daily_by_job": _daily("job_id"),
        "daily_by_campaign": _daily("campaign_id"),
        "daily_by_publisher": _daily("publisher_id"),
        "funnel_by_job": _funnel("job_id"),
        "funnel_by_publisher": _funnel("publisher_id"),
        "fact_by_company": _by_dimension("company_id", "nation", "n_nationkey", "n_name", "name"),
        "fact_by_publisher": _by_dimension(
            "publisher_id", "supplier", "s_suppkey", "s_name", "publisher_name"),
        "fact_by_group": _by_dimension("group_id", "region", "r_regionkey", "r_name", "name"),
        "campaign_spend_vs_budget": _on_fact("""
            select f.campaign_id, any_value(p_name) as campaign_name,
              any_value(p_retailprice) as budget_total,
              round(coalesce(sum(exact_spend), 0) + 1e-9, 4) as spend,
              round(any_value(p_retailprice) - coalesce(sum(exact_spend), 0) + 1e-9, 4) as budget_left,
              round(coalesce(sum(exact_spend), 0) / nullif(any_value(p_retailprice), 0) + 1e-9, 4)
                as budget_share
            from fact f left join part p on p.p_partkey = f.campaign_id
            group by f.campaign_id"""),
        "id_mismatch_audit": _with("""
            select c.job_id, c.campaign_id, c.group_id, count(*) as events,
              cast(j.campaign_id as double) as job_campaign_id,
              cast(j.group_id as double) as job_group_id
            from clean c join job j on j.id = c.job_id
            where c.campaign_id is distinct from j.campaign_id
              or c.group_id is distinct from j.group_id
            group by all""", *_CLEAN, "job"),
        "unrecognized_events": _with(
            "select custom_track, count(*) as events from clean where custom_track is null or "
            "custom_track not in ('click', 'conversion', 'qualified', 'unqualified') group by 1",
            *_CLEAN),
        "bad_uuid_audit": _with("""
            select case when event_id % 101 = 0 then 'missing'
              when event_id % 107 = 0 then 'not_time_uuid' else 'time_uuid' end as key_state,
              count(*) as row_count
            from messages group by 1""", *_SENT),
        "rejected_ids": _with("""
            select job_id, publisher_id, group_id, campaign_id, count(*) as events,
              'job_id' as reason
            from clean where job_id <> floor(job_id)
              and custom_track in ('click', 'conversion', 'qualified', 'unqualified')
            group by all""", *_CLEAN),
        "late_rows": _with("""
            select "offset", cast(event_id % 4 as int) as partition, create_time,
              case when event_id % 109 = 0 then 'ahead' else 'late' end as reason
            from messages where reject_reason is null
              and (event_id % 109 = 0 and copy = 0 or event_id % 109 <> 0 and event_id % 113 = 0)""",
            *_SENT),
        "events_to_json": _with(f"select {_MESSAGE}, ts_text as ts from tracking", *_BASE),
        "json_decode": _with(
            f'select "offset", {_MESSAGE}, ts_text as ts from messages '
            "where reject_reason is null", *_SENT),
        "dead_letter": _with(
            'select "offset", reject_reason from messages where reject_reason is not null',
            *_SENT),
        "tracking_upsert": _latest(),
        "stream_ingest": _latest(", cast(event_ts as date) as dates"),
        "fact_from_messages": _on_last_sent(f"select {_FACT_COLUMNS} from fact"),
        "versioned_load": _on_last_sent(f"select {_FACT_COLUMNS} from fact"),
        "file_ledger_load": _on_fact(f"select {_FACT_COLUMNS} from fact"),
        "daily_rollup": _daily("job_id"),
        "stream_hourly_changes": _on_last_sent(_ALL_CELLS),
        "stream_first_copies": _with(
            f"select {_MESSAGE}, ts_text as ts from messages where reject_reason is null and copy = 0", *_SENT),
        "stream_closed_hours": _on_open_hours(_ALL_CELLS),
        "stream_late_events": _with(
            "select \"offset\", create_time, clock, 'hour closed' as reason from judged where late", *_SENT, **_GATE),
        "stream_dedup": _with(
            "select distinct create_time, custom_track, job_id, publisher_id, campaign_id, "
            "group_id from messages where reject_reason is null", *_SENT),
    }

