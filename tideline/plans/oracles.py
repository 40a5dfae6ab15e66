"""Equivalent SQL of the registered queries, written independently of the Spark plans."""

from __future__ import annotations

EVENTS = """
    select cast(user_id as varchar) as k, event_type as name, props, value,
           epoch_us(ts) // 1000000 as t
    from events"""

COUNTS = """'{' || string_agg('"' || name || '":' || n, ',' order by name) || '}'"""


def sessions(source: str, gap: int, prefix: str = "") -> str:
    """CTEs ending in `{prefix}s (k, start, last, counts, wave)` for rows (k, name, t, wave)."""
    p = prefix
    return f"""
    {p}a as (select *, lag(t) over (partition by k order by t) as prev from {source}),
    {p}b as (select *, sum(case when prev is null or t - prev >= {gap} then 1 else 0 end)
                over (partition by k order by t) as no from {p}a),
    {p}c as (select k, no, name, count(*) as n, min(t) as lo, max(t) as hi, max(wave) as wave
             from {p}b group by k, no, name),
    {p}s as (select k, min(lo) as start, max(hi) as last, {COUNTS} as counts, max(wave) as wave
             from {p}c group by k, no)"""


def rows(extra: str = "") -> str:
    return f"""k as "sessionId", start as session_start,
        cast(last - start as integer) as "sessionLengthSeconds", counts as "messageCount"{extra}"""


WAVES = f"ev as (select *, case when value > 100 then 2 else 1 end as wave from ({EVENTS})), " \
        "w1 as (select * from ev where wave = 1)"
PLAIN = f"ev as (select *, 1 as wave from ({EVENTS}))"
WIDE = 21_600

REVISIONS = f"""{WAVES}, {sessions('w1', WIDE, 'f')}, {sessions('ev', WIDE, 'g')},
    rev as (select k, start, last, counts, cast(1 as bigint) as rt from fs
            union all select k, start, last, counts, cast(2 as bigint) from gs where wave = 2),
    ded as (select * from (select *, row_number() over (
                partition by k, start // 60 order by rt desc) as rn from rev) where rn = 1)"""

ALL_SESSIONS = f"with {PLAIN}, {sessions('ev', WIDE)} select {rows()} from s"
DEDUPED = f"with {REVISIONS} select {rows(', rt')} from ded"
MINUTES = f"with {PLAIN}, {sessions('ev', WIDE)} select distinct start // 60 * 60 as m from s"

FINALS = f"""
        with {PLAIN}, {sessions('ev', WIDE)}
        select {rows()} from s
        where last + 2 * {WIDE} + 86400 <= (select max(t) from ev)"""


def gathered(changes: str, delay: int) -> str:
    """CTE `g (k, opened)`: per key, the first change and then each first one that `delay` seconds had passed for."""
    return f"""
    g as (select k, min(t) as opened from {changes} group by k
          union all
          select g.k, (select min(c.t) from {changes} c where c.k = g.k and c.t >= g.opened + {delay}) as following
          from g where following is not null)"""


def panes(source: str, condition: str, extra: str = "") -> str:
    """CTE `p`: what a session of a whole key held at the time of each of its panes `g`."""
    return f"""
    h as (select g.k, g.opened, e.name, count(*) as n, min(e.t) as lo, max(e.t) as hi
          from g join {source} e on e.k = g.k and ({condition}) group by g.k, g.opened, e.name),
    p as (select k, opened, min(lo) as start, max(hi) as last, {COUNTS} as counts from h group by k, opened){extra}"""


# Thirds of the arrival range, as the replays cut it; `d` holds arrivals.
THIRDS = """
    r as (select min(arrival) as low, (max(arrival) - min(arrival)) // 3 + 1 as third from d),
    w as (select d.*, (arrival - low) // third + 1 as wave from d, r)"""


ORACLES: dict[str, str] = {
    "session_metrics": ALL_SESSIONS,
    "session_metrics_60s": f"with {PLAIN}, {sessions('ev', 60)} select {rows()} from s",
    "session_message_counts": f"""
        with {PLAIN}, {sessions('ev', WIDE)}, starts as (select k, no, min(lo) as start from c group by k, no)
        select c.k as "sessionId", starts.start as session_start, c.name as message_name, c.n
        from c join starts on c.k = starts.k and c.no = starts.no""",
    "order_sessions": f"""
        with ev as (select cast(o_custkey as varchar) as k, o_orderpriority as name,
                           epoch_us(o_orderdate) // 1000000 as t, 1 as wave from orders),
        {sessions('ev', 30 * 86_400)} select {rows()} from s""",
    "sessions_per_minute": f"""
        with {PLAIN}, {sessions('ev', WIDE)}
        select start // 60 * 60 as minute_second, count(*) as sessions,
               cast(sum(last - start) as bigint) as total_seconds from s group by 1""",
    "partition_paths": f"""
        with m as (select distinct t // 60 * 60 as s from ({EVENTS})),
        p as (select s, make_timestamp(s * 1000000) as ts from m)
        select s as minute_second,
               strftime(ts, 'y=%Y/mo=%m/d=%d/h=%H/mi=%M') as path,
               strftime(ts, 'y=%Y/m=%m/d=%d/h=%H/m=%M') as legacy_path,
               strftime(ts, 'y=%Y/mo=%m/d=%d/h=%H/mi=%M') || '/rt=' || (s * 1000) as raw_path,
               s as path_second, s as legacy_path_second
        from p""",
    "raw_revisions": f"with {REVISIONS} select {rows(', rt')} from rev",
    "dedupe_latest": DEDUPED,
    "dedupe_sql_view": DEDUPED,
    "dedupe_job": DEDUPED,
    "dedupe_job_minute": DEDUPED,
    "reconciled_sessions": ALL_SESSIONS,
    "availability_notices": f"""select '{{"event_time_second":' || m || '}}' as value from ({MINUTES})""",
    "notice_roundtrip": f"select m as event_time_second from ({MINUTES})",
    "late_quarantine": f"""
        with d as (select *, t + cast(floor(value * 1800) as bigint) as arrival from ({EVENTS}))
        select k as session_id, name as message_name, t as event_sec, arrival as arrival_sec,
               'skew' as reason
        from d where arrival - t > 86400""",
    "over_late_messages": f"""
        with d as (select *, t + cast(floor(value * 60) as bigint) as arrival from ({EVENTS})),
        tops as (select arrival // 86400 as batch, max(arrival) as top from d group by 1)
        select k as session_id, name as message_name, t as event_sec, arrival as arrival_sec,
               (select max(top) from tops where tops.batch < d.arrival // 86400) as watermark_sec
        from d where t + 60 + 3600 <= watermark_sec""",
    "decoded_messages": f"""
        select k as session_id, name as message_name, props as message_value, t as event_sec,
               t as arrival_sec, true as decoded from ({EVENTS})""",
    "undecodable_messages": f"""
        select t as arrival_sec, 'undecodable' as reason, true as explained, true as payload_kept
        from ({EVENTS}) where t % 7 = 0""",
    "stream_revisions": f"""
        with {WAVES}, {sessions('w1', WIDE, 'f')}, {sessions('ev', WIDE, 'g')},
        wm as (select max(t) as w from w1)
        select {rows(", 'on_time' as pane")} from fs, wm where last + {WIDE} <= w
        union all
        select {rows(f", case when last + {WIDE} <= w then 'late' else 'on_time' end as pane")}
        from gs, wm where wave = 2 or last + {WIDE} > w""",
    "stream_reconciled": ALL_SESSIONS,
    "stream_final_sessions": FINALS,
    "native_final_sessions": FINALS,
    "reconciled_foreign": f"""
        with o as (
            select cast(o_custkey as varchar) as k, epoch_us(o_orderdate) // 1000000 as start,
                   o_orderkey * 7919 % 90 * 86400 as length, cast(round(o_totalprice * 100) as bigint) % 1000 as rt,
                   '{{"' || o_orderpriority || '":1}}' as counts, o_orderkey as id
            from orders)
        select k as "sessionId", start as session_start, cast(length as integer) as "sessionLengthSeconds",
               counts as "messageCount", rt
        from o where not exists (
            select 1 from o b where b.k = o.k and b.rt > o.rt
            and b.start < o.start + o.length + 30 * 86400 and o.start < b.start + b.length + 30 * 86400)""",
    "reconcile_job": ALL_SESSIONS,
    "stream_minute_totals": f"""
        with f as ({FINALS})
        select session_start // 60 * 60 as minute_second, count(*) as sessions,
               cast(sum("sessionLengthSeconds") as bigint) as total_seconds
        from f group by 1""",
    "stream_early_panes": f"""
        with recursive {PLAIN}, {gathered('ev', 86_400)}, {panes('ev', 'e.t < g.opened + 86400')}
        select {rows(", 'early' as pane")} from p where opened + 86400 <= (select max(t) from ev)""",
    # Sessions close after the second wave; a later wave's time of arrival is its time plus 120 days.
    "stream_late_panes": f"""
        with recursive ev as (
            select *, case when value > 100 then 3 when value > 90 then 2 else 1 end as wave from ({EVENTS})),
        late as (select k, t from ev where wave = 3), {gathered('late', 86_400)},
        {panes('ev', 'e.wave < 3 or e.t < g.opened + 86400')},
        first as (select k, name, count(*) as n, min(t) as lo, max(t) as hi from ev where wave < 3 group by k, name),
        closed as (select k, min(lo) as start, max(hi) as last, {COUNTS} as counts from first group by k)
        select {rows(", 'late' as pane")} from p where opened + 86400 <= (select max(t) from late)
        union all
        select {rows(", 'on_time' as pane")} from closed""",
    "stream_late_drops": f"""
        with d as (select *, t + cast(floor(value * 600) as bigint) as arrival from ({EVENTS})), {THIRDS},
        tops as (select wave, max(arrival) as top from w group by wave),
        m as (select w.*, (select max(top) from tops where tops.wave < w.wave) as watermark from w)
        select k as session_id, name as message_name, count(*) as n, t as event_sec, watermark * 1000 as watermark_ms
        from m where t + 3600 + 3600 <= watermark group by k, name, t, watermark""",
    "stream_minute_layout": f"""
        with ev as (select cast(o_custkey as varchar) as k, o_orderpriority as name,
                           epoch_us(o_orderdate) // 1000000 as t, 1 as wave from orders),
        {sessions('ev', 10_000 * 86_400)} select {rows()} from s""",
    "stream_metrics": f"""
        with {WAVES}, {sessions('w1', WIDE, 'f')}, {sessions('ev', WIDE, 'g')},
        wm as (select max(t) as w from w1),
        panes as (
            select 'on_time' as pane from fs, wm where last + {WIDE} <= w
            union all
            select case when last + {WIDE} <= w then 'late' else 'on_time' end from gs, wm where wave = 2 or last + {WIDE} > w)
        select 'messages' as observed, 'rows' as metric, count(*) as value from ev
        union all select 'messages', 'rejected', 0
        union all select 'messages', 'first_event_sec', min(t) from ev
        union all select 'messages', 'last_event_sec', max(t) from ev
        union all select 'revisions', pane, count(*) from panes group by pane
        union all select 'revisions', 'dropped_messages', 0""",
}
