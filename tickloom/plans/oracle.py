"""DuckDB SQL oracles over the driver's tables, one per registered query.

They restate each query's semantics from scratch on ``events``: the fixture
derivation (FIXTURES 5), then the operator. Timestamps are naive UTC.
"""

from tickloom.plans import queries as Q

# The fixture derivation of FIXTURES 5, as SQL. ms uses epoch_us // 1000
# because DuckDB's epoch_ms rounds while Spark's unix_millis floors.
FX = """fx as (
  select event_id, event_type, user_id, value, ts,
         upper(event_type) as base,
         (['USDT','USDC','BTC','ETH'])[user_id % 4 + 1] as quote,
         epoch_us(ts) // 1000 as own_ms,
         -- every fifth event carries the time of its full hour
         case when event_id % 5 = 0 then own_ms // 3600000 * 3600000 else own_ms end as ms,
         -- some users trade a base with a hyphen of its own
         case when user_id % 7 = 0 then upper(event_type)[1:2] || '-' || upper(event_type)[3:]
              else upper(event_type) end as hyphenated
  from events)"""

# Kucoin ticker messages: one per event. The control frames that error events
# bring besides are dropped.
KU = """ku as (
  select event_id, hyphenated || '-' || quote as subject, replace(hyphenated || '-' || quote, '-', '') as symbol,
         value as price, make_timestamp(ms * 1000) as time, ms, ts, 0 as pos, 'kucoin' as source
  from fx)"""

# Binance elements: every event, one element each.
BI = """bi as (
  select event_id, base || quote as subject, base || quote as symbol,
         value as price, make_timestamp(ms * 1000) as time, ms, ts, 0 as pos, 'binance' as source
  from fx)"""

QUOTED = "(symbol like '%USDT' or symbol like '%USDC')"
TICKS = f"""ticks as (
  select * from ku where {QUOTED}
  union all
  select * from bi where {QUOTED})"""


def fold_sql(src: str, key: str, size: int, timeout: int) -> str:
    """A1 by recursion: walk each key's rows in (ms, event_id) order carrying
    (batch start, count, batch id, closed-after-this-row)."""
    first_close = f"(1 >= {size} or 0 >= {timeout})"
    return f"""
with recursive {FX}, {KU}, {BI},
o as (
  select {key} as k, event_id, ms,
         row_number() over (partition by {key} order by ms, event_id) as rn
  from {src}),
f as (
  select k, rn, ms, ms as st, 1 as n, 0::bigint as b, {first_close} as c from o where rn = 1
  union all
  select o.k, o.rn, o.ms,
         case when f.c then o.ms else f.st end,
         case when f.c then 1 else f.n + 1 end,
         case when f.c then f.b + 1 else f.b end,
         case when f.c then {first_close} else (f.n + 1 >= {size} or o.ms - f.st >= {timeout}) end
  from f join o on o.k = f.k and o.rn = f.rn + 1)"""


SQL: dict[str, str] = {}

SQL["kucoin_normalize"] = f"""
with {FX}, {KU}
select symbol, price, time, 'kucoin' as source from ku where {QUOTED}
"""

SQL["binance_normalize"] = f"""
with {FX}, {BI}
select symbol, price, time, 'binance' as source from bi where {QUOTED}
"""

SQL["kucoin_price_float32"] = f"""
with {FX}, {KU}
select symbol, cast(cast(price as float) as double) as price, time, 'kucoin' as source
from ku where {QUOTED}
"""

SQL["unified_feed"] = f"""
with {FX}, {KU}, {BI}, {TICKS}
select symbol, price, time, source from ticks
"""

SQL["control_frame_filter"] = f"""
with {FX}
select event_id, 'message' as type, hyphenated || '-' || quote as subject from fx
union all
select event_id, 'notice' as type, hyphenated || '-' || quote as subject
from fx where event_type = 'error' and event_id % 3 = 0
"""

SQL["message_type_filter"] = f"""
with {FX}, {KU}
select event_id, 'message' as type, subject from ku
"""

SQL["valid_rejects"] = f"""
with {FX},
d as (
  select event_id, replace(hyphenated || '-' || quote, '-', '') as symbol,
         case when event_id % 97 in (0, 1) then 'malformed'
              when value >= 101 and value < 102 then 'missing:data.bestAsk'
              when event_id % 89 = 0 then 'missing:data.time' end as broken,
         case when value < 1 then 'empty' when value >= 200 then 'nan'
              when value >= 100 and value < 101 then 'abc' else null end as bad,
         value
  from fx)
select event_id, symbol,
       case when bad is null then value end as price,
       case when bad is null then null else 'bad:price' end as reason
from d where broken is null and {QUOTED}
union all
select event_id, null as symbol, null::double as price, broken as reason
from d where broken is not null
"""

SQL["flatten_ticker"] = f"""
with {FX}
select '/market/ticker:all' as topic, 'message' as type, hyphenated || '-' || quote as subject,
       case when value >= 101 and value < 102 then '' else cast(value as varchar) end as bestAsk,
       cast(user_id as varchar) as bestAskSize,
       cast(value as varchar) as bestBid, cast(user_id as varchar) as bestBidSize,
       cast(value as varchar) as price, cast(event_id as varchar) as sequence,
       cast(user_id as varchar) as size, cast(ms as varchar) as time
from fx
"""

SQL["event_time_by_source"] = f"""
with {FX}, {KU}, {BI}
select source, time as event_time from ku
union all
select source, time as event_time from bi
"""

SQL["object_key"] = f"""
with {FX}, {KU}
select event_id, 'kucoin/' || strftime(ts, '%Y-%m-%dT%H-%M-%S') || '.json' as object_key from ku
"""

SQL["hourly_key"] = f"""
with {FX}, {KU}
select event_id,
       'raw/kucoin/' || strftime(time, '%Y/%m/%d/%H') || '/data_' || strftime(time, '%Y%m%dT%H') || '.json.gz'
       as hour_key
from ku
"""

SQL["object_overwrite"] = f"""
with {FX}, {KU}, {BI}, {TICKS},
k as (
  select *, 'raw/' || source || '/' || strftime(time, '%Y/%m/%d/%H') || '/data_' || strftime(time, '%Y%m%dT%H')
            || '.json.gz' as object_key
  from ticks)
select object_key, symbol, price, time from k
qualify row_number() over (partition by object_key order by ms desc, event_id desc) = 1
"""

SQL["current_price"] = f"""
with {FX}, {KU}, {BI}, {TICKS}
select source, symbol, price, time from ticks
qualify row_number() over (partition by source, symbol order by ms desc, event_id desc) = 1
"""

SQL["micro_batch"] = fold_sql("ku", "subject", Q.BATCH_SIZE, Q.BATCH_TIMEOUT_MS) + """
select k as subject, b as batch_id, count(*) as n, min(ms) as first_ms, max(ms) as last_ms
from f group by 1, 2
"""

SQL["micro_batch_source"] = fold_sql(
    "(select * from ku union all select * from bi)", "source",
    Q.SOURCE_BATCH_SIZE, Q.SOURCE_BATCH_TIMEOUT_MS) + """
select k as source, b as batch_id, count(*) as n, min(ms) as first_ms, max(ms) as last_ms
from f group by 1, 2
"""

SQL["micro_batch_time_only"] = fold_sql(
    "(select * from ku union all select * from bi)", "source", Q.TIME_ONLY_SIZE, Q.TIME_ONLY_TIMEOUT_MS) + """
select k as source, b as batch_id, count(*) as n, min(ms) as first_ms, max(ms) as last_ms
from f group by 1, 2
"""

SQL["micro_batch_feed_symbol"] = fold_sql(
    "(select * from ku union all select * from bi)", "source || '|' || subject",
    Q.BATCH_SIZE, Q.BATCH_TIMEOUT_MS) + """
select split_part(k, '|', 1) as source, split_part(k, '|', 2) as subject, b as batch_id, count(*) as n,
       min(ms) as first_ms, max(ms) as last_ms
from f group by k, b
"""

SQL["micro_batch_aligned"] = f"""
with {FX}, {KU},
w as (
  select subject, ms, window_start,
         (row_number() over (partition by subject, window_start order by ms, event_id) - 1)
           // {Q.ALIGNED_SIZE} as chunk
  from (select *, make_timestamp(ms // 43200000 * 43200000 * 1000) as window_start from ku))
select subject, window_start, chunk, count(*) as n, min(ms) as first_ms, max(ms) as last_ms
from w group by 1, 2, 3
"""

SQL["batch_envelope"] = fold_sql("ku", "subject", Q.BATCH_SIZE, Q.BATCH_TIMEOUT_MS) + """,
g as (select f.k, f.b, o.event_id, f.ms from f join o on o.k = f.k and o.rn = f.rn)
select g.k as subject, g.b as batch_id, count(*) as n, 'kucoin' as source,
       arg_min(ku.ts, (g.ms, g.event_id)) as first_ingest_ts, count(*) as n_in_message
from g join ku on ku.event_id = g.event_id
group by 1, 2
"""

SQL["array_roundtrip"] = f"""
with {FX}, {KU}
select event_id, subject, price, time from ku
"""

SQL["replay_ingest_range"] = f"""
with {FX}, {KU},
fl as (select *, min(ts) over (partition by epoch_us(ts) // {Q.FLUSH_SECONDS}000000) as first_ts from ku)
select symbol, price, time, 'kucoin' as source from fl
where {QUOTED}
  and date_trunc('second', first_ts) between timestamp '{Q.REPLAY_START}' and timestamp '{Q.REPLAY_END}'
"""

SQL["replay_event_range"] = f"""
with {FX}, {KU}, {BI}, {TICKS}
select symbol, price, time, source from ticks
where time between timestamp '{Q.REPLAY_START}' and timestamp '{Q.REPLAY_END}'
"""

SQL["stream_normalize"] = SQL["unified_feed"]
SQL["stream_micro_batch"] = SQL["micro_batch"]
SQL["stream_current_price"] = SQL["current_price"]
SQL["stream_current_price_backfill"] = SQL["current_price"]
SQL["stream_load_current"] = SQL["current_price"]
SQL["narrow_projection"] = SQL["kucoin_normalize"]
SQL["flat_csv_roundtrip"] = SQL["flatten_ticker"]
SQL["transformed_roundtrip"] = SQL["unified_feed"]

SQL["tee_roundtrip"] = f"""
with {FX}, {KU}
select sink, event_id, symbol, price from ku, (values ('lake'), ('log')) s(sink) where {QUOTED}
"""

# Landed records: Kucoin's keep their own ingest time, Binance's that of their frame
# (the last event of the frame); a flush is named after its first record.
SQL["stream_landing"] = f"""
with {FX}, {KU}, {BI},
landed as (
  select source, ts as ingest_ts from ku
  union all
  select source, max(ts) over (partition by ms // 3600000) as ingest_ts from bi),
named as (
  select *, min(ingest_ts) over (partition by source, epoch_us(ingest_ts) // {Q.FLUSH_SECONDS}000000) as first_ts
  from landed)
select source, source || '/' || strftime(first_ts, '%Y-%m-%dT%H-%M-%S') || '.json' as object_key, ingest_ts from named
"""

# Objects: the records of each flush under its name, both feeds.
OBJECTS = f"""{FX}, {KU}, {BI},
landed as (
  select *, ts as ingest_ts from ku
  union all
  select *, max(ts) over (partition by ms // 3600000) as ingest_ts from bi),
named as (
  select *, min(ingest_ts) over (partition by source, epoch_us(ingest_ts) // {Q.OBJECT_SECONDS}000000) as first_ts
  from landed),
objects as (
  select *, source || '/' || strftime(first_ts, '%Y-%m-%dT%H-%M-%S') || '.json' as object_key from named)"""

SQL["object_scan"] = f"""
with {OBJECTS}
select object_key, symbol, price, time from objects
where {QUOTED}
  and date_trunc('second', first_ts) between timestamp '{Q.REPLAY_START}' and timestamp '{Q.REPLAY_END}'
"""

SQL["object_manifest"] = f"""
with {OBJECTS}
select object_key, count(*) as rows, min(ms) as first_event_ms, max(ms) as last_event_ms, true as whole
from objects group by object_key
"""

SQL["object_manifest_replay"] = SQL["replay_event_range"]

# What is left of the feeds after their outages, and the silences in it.
GAPS = f"""{FX}, {KU}, {BI}, {TICKS},
partial as (
  select source, symbol, ms from ticks
  where not ({" or ".join(f"(source = '{s}' and time between timestamp '{a}' and timestamp '{b}')"
                          for s, (a, b) in Q.OUTAGES.items())})
    and time between timestamp '{Q.SPAN[0]}' and timestamp '{Q.SPAN[1]}'),
marks as (
  select * from partial
  union all
  select distinct source, symbol, epoch_us(timestamp '{Q.SPAN[0]}') // 1000 - 1 from partial
  union all
  select distinct source, symbol, epoch_us(timestamp '{Q.SPAN[1]}') // 1000 + 1 from partial),
gaps as (
  select source, symbol, after_ms, ms as before_ms, ms - after_ms as silence_ms
  from (select *, lag(ms) over (partition by source, symbol order by ms) as after_ms from marks)
  where ms - after_ms > {Q.TOLERATED_MS})"""

SQL["gap_intervals"] = f"""
with {GAPS}
select source, symbol, after_ms, before_ms, silence_ms from gaps
"""

SQL["gap_ranges"] = f"""
with {GAPS},
i as (
  select *, sum(case when after_ms > reach then 1 else 0 end) over (partition by source order by after_ms, before_ms, symbol
                rows unbounded preceding) as island
  from (select *, max(before_ms) over (partition by source order by after_ms, before_ms, symbol
                  rows between unbounded preceding and 1 preceding) as reach from gaps))
select source, min(after_ms) as after_ms, max(before_ms) as before_ms, count(*) as gaps from i group by source, island
"""

SQL["gap_fill"] = SQL["unified_feed"]
SQL["gap_fill_current"] = SQL["current_price"]

MESSAGES = f"""{FX},
e as (
  select *, event_id // {Q.MESSAGE_RECORDS} as message, replace(hyphenated || '-' || quote, '-', '') as symbol,
         row_number() over (partition by event_id // {Q.MESSAGE_RECORDS} order by event_id) - 1 as pos,
         case when event_id % 61 = 7 or event_id % 67 = 3 then 'not an object'
              when value >= 101 and value < 102 then 'missing:data.bestAsk'
              when event_id % 89 = 0 then 'missing:data.time' end as bad
  from fx),
m as (
  select message, message // 8 as poll,
         case when message % 37 = 5 then 'not an array' when message % 41 = 6 then 'malformed'
              when message % 43 = 7 then null else arg_min(bad, pos) filter (where bad is not null) end as reason,
         case when message % 37 = 5 or message % 41 = 6 or message % 43 = 7 then null
              else min(pos) filter (where bad is not null) end as bad_pos,
         case when message % 43 = 7 then 0 else count(*) end as n
  from e group by message)"""

SQL["atomic_messages"] = f"""
with {MESSAGES}
select message, case when reason is null then n end as records, bad_pos::integer as bad_pos, reason from m
"""

SQL["atomic_ticks"] = f"""
with {MESSAGES}
select symbol, value as price, make_timestamp(ms * 1000) as time, 'kucoin' as source
from e join m using (message) where reason is null and n > 0 and {QUOTED}
"""

SQL["atomic_polls"] = f"""
with {MESSAGES},
p as (select *, bool_or(reason is not null) over (partition by poll) as hit from m)
select message, poll, case when not hit then n end as records,
       case when reason is null and hit then 'poll' else reason end as reason
from p
"""

ROUTED = f"""{FX}, {BI},
r as (
  select 'kucoin' as feed, event_id, replace(hyphenated || '-' || quote, '-', '') as symbol, value,
         value < 1 or value >= 200 or (value >= 100 and value < 101) as dirty from fx
  union all
  select 'binance', event_id, symbol, price, false from bi),
o as (
  select *, case when event_id % 50 = 3 then 'kraken' when event_id % 50 = 4 then null else feed end as source,
         event_id % 53 = 9 as cut, {QUOTED} as quoted
  from r),
routed as (
  select feed, event_id, source, symbol, value, cut, quoted, dirty,
         case when source is null or source = 'kraken' then 'unknown' when cut then 'reject' when not quoted then 'other'
              when dirty then 'reject' else 'tick' end as outcome
  from o)"""
ROUTED_OUT = """feed, event_id, outcome, source,
       case when outcome in ('tick', 'other') then symbol end as symbol,
       case when outcome in ('tick', 'other') and not dirty then value end as price,
       case when outcome = 'unknown' then 'unknown source: ' || coalesce(source, 'null')
            when outcome = 'reject' then case when cut then 'malformed' else 'bad:price' end end as reason"""

SQL["dead_letter_routing"] = f"""
with {ROUTED}
select {ROUTED_OUT} from routed
"""

# The second pass knows kraken's records (they are laid out like Kucoin's).
SQL["stream_dead_letter"] = f"""
with {ROUTED},
again as (
  select * replace (case when source is null then 'unknown' when cut then 'reject' when not quoted then 'other'
                         when dirty then 'reject' else 'tick' end as outcome)
  from routed where outcome = 'unknown' and feed = 'kucoin')
select 1 as pass, {ROUTED_OUT} from routed
union all
select 2 as pass, {ROUTED_OUT} from again
"""
SQL["stream_micro_batch_hot"] = SQL["micro_batch_source"]

POINTS = f"""{FX}, {KU}, {BI}, {TICKS},
points as (
  select source, symbol, time, arg_max(price, event_id) as price from ticks group by source, symbol, time)"""

SQL["price_at_instants"] = f"""
with {POINTS}
select instant, source, symbol, arg_max(price, time) as price, max(time) as time
from points, (values {", ".join(f"(timestamp '{t}')" for t in Q.INSTANTS)}) i(instant)
where time <= instant group by instant, source, symbol
"""

SQL["price_intervals"] = f"""
with {POINTS}
select source, symbol, price, time as valid_from, lead(time) over (partition by source, symbol order by time) as valid_to
from points
"""

SQL["stream_price_state"] = SQL["current_price"]
SQL["stream_produce_once"] = SQL["kucoin_normalize"]

# A1 + A6 by recursion over each key's rows in order of arrival. A batch that
# neither size nor time closed was closed by silence, unless the clock (the last
# arrival of all) is not past the key's limit.
SQL["stream_idle_flush"] = f"""
with recursive {FX}, {KU},
o as (
  select subject as k, epoch_us(ts) // 1000 as ms,
         row_number() over (partition by subject order by epoch_us(ts) // 1000, event_id) as rn
  from ku),
f as (
  select k, rn, ms, ms as st, 1 as n, 0::bigint as b from o where rn = 1
  union all
  select o.k, o.rn, o.ms, case when x.fresh then o.ms else f.st end,
         case when x.fresh then 1 else f.n + 1 end, case when x.fresh then f.b + 1 else f.b end
  from f join o on o.k = f.k and o.rn = f.rn + 1,
       lateral (select f.n >= {Q.BATCH_SIZE} or f.ms - f.st >= {Q.BATCH_TIMEOUT_MS}
                       or o.ms - f.ms > {Q.IDLE_MS} as fresh) x),
g as (
  select k as subject, b as batch_id, count(*) as n, min(ms) as first_ms, max(ms) as last_ms,
         b = max(b) over (partition by k) as newest
  from f group by k, b)
select subject, batch_id, n, first_ms, last_ms,
       case when n >= {Q.BATCH_SIZE} then 'size'
            when last_ms - first_ms >= {Q.BATCH_TIMEOUT_MS} then 'time'
            when not newest or (select max(ms) from o) - last_ms > {Q.IDLE_MS} then 'idle' end as closed_by
from g
"""
