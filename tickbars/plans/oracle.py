"""The registered queries again, as SQL over the same tables."""

from __future__ import annotations

TICKS = """
raw as (
  select *, cast(json_extract_string(props, '$.k') as integer) as k from events
),
ticks as (
  select 'coin_' || user_id as name_coin,
         event_type as symbol_coin,
         event_id,
         cast(event_id as varchar) as id,
         cast(value * 10 as decimal(18,2)) as volume,
         cast(value * (k + 1) as decimal(18,2)) as market_cap,
         cast(value as decimal(18,2)) as price,
         cast(k as decimal(18,2)) as price_old,
         cast(k - 50 as double) as percent_change_24hr,
         {time} as time_stamp,
         k
  from raw
),
totals as (
  select cast(time_stamp as date) as day,
         cast(sum(volume) as double) as total_24_volume,
         cast(sum(market_cap) as double) as total_market_cap
  from ticks group by all
),
metrics as (
  select ticks.*, total_24_volume, total_market_cap,
         100 * cast(volume as double) / nullif(total_24_volume, 0) as percent_volume,
         100 * cast(market_cap as double) / nullif(total_market_cap, 0) as percent_market_cap,
         100 * cast(price - price_old as double) / nullif(cast(price_old as double), 0) as percent_change,
         cast(market_cap as double) / nullif(cast(price as double), 0) as cir_supply
  from ticks join totals on day = cast(time_stamp as date)
)
"""
EXACT = "with " + TICKS.format(time="ts")
# Messages carry whole epoch seconds.
SECONDS = "with " + TICKS.format(time="date_trunc('second', ts)")
HOURS = "with " + TICKS.format(time="date_trunc('hour', ts)")

BARS = """
with bars as (
  select l_orderkey * 8 + l_linenumber as sno,
         'S' || l_suppkey as name,
         l_returnflag as symbol,
         cast(l_shipdate as date) as date,
         l_extendedprice * (1 + l_tax) as high,
         l_extendedprice * (1 - l_discount) as low,
         l_extendedprice as open,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) as close,
         l_quantity as volume,
         l_extendedprice * l_quantity as market_cap
  from lineitem
)
"""

DAILY = f"""{BARS.rstrip()[:-1]}
),
days as (
  select cast(date - date '1970-01-01' as integer) as sno,
         name, min(symbol) as symbol, date, max(high) as high, min(low) as low,
         arg_min(open, struct_pack(b := sno, c := open, d := close)) as open,
         arg_max(close, struct_pack(b := sno, c := open, d := close)) as close,
         sum(volume) as volume,
         cast(sum(cast(market_cap as decimal(18,2))) as double) as market_cap
  from bars group by name, date
)
"""

LIVE_COLUMNS = """
  name_coin, symbol_coin, cast(volume as double) as volume, cast(market_cap as double) as market_cap,
  cir_supply, cast(price as double) as price, percent_change, percent_volume, percent_market_cap, time_stamp
"""


def bars_by(grain: str, label: str, where: str = "true", source: str = "bars") -> str:
    return f"""{BARS if source == "bars" else DAILY}
select name, strftime(date, '{label}') as "{grain}",
       max(high) as highest_high,
       min(low) as lowest_low,
       arg_min(open, struct_pack(a := date, b := sno, c := open, d := close)) as first_open,
       arg_max(close, struct_pack(a := date, b := sno, c := open, d := close)) as last_close,
       round(cast(sum(cast(volume as decimal(18,2))) as double), 2) as total_volume,
       round(cast(sum(cast(market_cap as decimal(18,2))) as double), 2) as total_marketcap
from {source} where {where} group by all
"""


def top_bars(by: str, source: str = "bars") -> str:
    return f"""{BARS if source == "bars" else DAILY}
select name as name_coin, symbol as symbol_coin, date, high, low, open, close, volume, market_cap
from (select *, rank() over (order by {by} desc) as r from {source}) where r <= 10
"""


def summary(average: str) -> str:
    return f"""{BARS}
select name, {average} as avg_price, min(open) as min_price, max(open) as max_price, max(market_cap) as max_market_cap
from bars group by name
"""


EXACT_MEAN = "cast(sum(cast(open as decimal(18,2))) as double) / count(*)"


def windows(ticks: str, seconds: int, slide: int, harmonic: bool = False, where: str = "true") -> str:
    extra = ", round(1 / avg(1 / nullif(cast(price as double), 0)), 6) as harmonic_mean" if harmonic else ""
    return f"""{ticks},
placed as (
  select symbol_coin, price, time_stamp,
         time_bucket(interval '{slide} seconds', time_stamp, timestamp '1970-01-01') - to_seconds(i * {slide})
           as start_time
  from ticks, range(0, {-(-seconds // slide)}) as steps(i)
)
select symbol_coin,
       cast(sum(price) as double) / count(*) as arithmetic_mean,
       round(exp(avg(case when price > 0 then ln(cast(price as double)) end)), 6) as geometric_mean,
       round(stddev_samp(cast(price as double)), 6) as standard_deviation{extra},
       start_time,
       start_time + to_seconds({seconds}) as end_time
from placed where time_stamp < start_time + to_seconds({seconds}) and {where} group by symbol_coin, start_time
"""


def leaders(ticks: str, order: str) -> str:
    return f"""{ticks}
select name_coin, max(time_stamp) as time_stamp, cast(max(price) as double) as price,
       max(percent_change) as percent_change
from metrics group by name_coin order by percent_change {order} nulls last, name_coin limit 10
"""


def share(ticks: str) -> str:
    return f"""{ticks}
select name_coin, max(time_stamp) as time_stamp, max(percent_volume) as percent_volume,
       max(percent_market_cap) as percent_market_cap
from metrics group by name_coin order by percent_market_cap desc nulls last, name_coin limit 10
"""


def newest_of_coin(columns: str, order: str) -> str:
    """The board of each coin's newest tick; equal times fall back to the larger values, NULL smallest."""
    return f"""{EXACT}
select name_coin, time_stamp, {columns} from (
  select *, row_number() over (
    partition by name_coin order by time_stamp desc, {order}) as r
  from metrics
) where r = 1
"""


def live_rows(ticks: str) -> str:
    return f"{ticks} select {LIVE_COLUMNS} from metrics"


def newest_price(ticks: str, batch: str) -> str:
    return f"""{ticks}
select {LIVE_COLUMNS} from (
  select *, row_number() over (
    partition by symbol_coin, time_stamp
    order by {batch} desc, name_coin desc, volume desc, market_cap desc, cir_supply desc nulls last, price desc,
             percent_change desc nulls last, percent_volume desc nulls last, percent_market_cap desc nulls last
  ) as r
  from metrics
) where r = 1
"""


def message_fields(time: str) -> str:
    return f"""
  name_coin, symbol_coin, id, cast(volume as double) as volume, cast(market_cap as double) as market_cap,
  cast(price as double) as price, cast(price_old as double) as price_old, percent_change_24hr,
  total_24_volume, total_market_cap, {time} as time_stamp
"""


def six_decimals(numerator: str, denominator: str) -> str:
    """A ratio of two whole numbers (cents, say) to six decimals, halves away from zero, by whole-number arithmetic."""
    a, b = (f"cast(round({x}) as hugeint)" for x in (numerator, denominator))
    return f"sign({a}) * ((2000000 * abs({a}) + {b}) // nullif(2 * {b}, 0)) / 1e6"


def twelve_decimals(column: str) -> str:
    """The shortest text of a double, to twelve decimals at most."""
    return f"rtrim(rtrim(cast(cast(cast({column} as varchar) as decimal(38,12)) as varchar), '0'), '.')"


HOURLY_BATCHES = newest_price(HOURS, "case when k < 33 then 0 when k < 66 then 1 else 2 end")

REJECTS = """
with raw as (select cast(json_extract_string(props, '$.k') as integer) as k from events)
select case k % 5 when 1 then 'missing name' when 2 then 'time range' when 3 then 'missing name'
                  when 4 then 'missing time' else 'none' end as reject_reason,
       count(*) as n
from raw group by 1
"""

FED = f"""{SECONDS},
fed as (
  select *, case when time_stamp < '2024-01-11' then 0 when time_stamp < '2024-01-21' then 1 else 2 end
            + case when k % 10 = 3 then 1 else 0 end as batch
  from ticks
),
marked as (
  select fed.*, high_water, high_water - interval 300 seconds as closed
  from fed left join (
    select batch, max(newest) over (order by batch rows between unbounded preceding and 1 preceding) as high_water
    from (select batch, max(time_stamp) as newest from fed group by batch)
  ) using (batch)
),
placed as (
  select *, time_bucket(interval '30 seconds', time_stamp, timestamp '1970-01-01') - to_seconds(i * 30) as start_time
  from marked, range(0, 10) as steps(i)
),
windowed as (
  select *, start_time + to_seconds(300) as end_time,
         closed is not null and start_time + to_seconds(300) <= closed as missed
  from placed where time_stamp < start_time + to_seconds(300)
)
"""

def top_bars_by_asset(by: str) -> str:
    return f"""{BARS}
select name as name_coin, symbol as symbol_coin, date, high, low, open, close, volume, market_cap
from (select *, rank() over (partition by name order by {by} desc) as r from bars) where r <= 10
"""


RANKED = """
select * exclude (r) from (
  select *, rank() over (order by percent_change desc) as r from (
    select name_coin, max(time_stamp) as time_stamp, cast(max(price) as double) as price,
           max(percent_change) as percent_change
    from metrics group by name_coin
  ) where percent_change is not null
) where r <= 10
"""

SNAPSHOT_TOTALS = """
select id,
       cast(sum(volume) over (partition by date_trunc('hour', time_stamp)) as double) as total_24_volume,
       cast(sum(market_cap) over (partition by date_trunc('hour', time_stamp)) as double) as total_market_cap
from ticks
"""

PRICE_HISTORY = f"""{EXACT}
select {LIVE_COLUMNS} from metrics
where symbol_coin = 'purchase' and time_stamp >= '2024-01-08' and time_stamp < '2024-01-22'
order by time_stamp desc
"""

PROBLEMS = f"""{DAILY}
select case sno % 7 when 1 then 'short line' when 2 then 'bad type' when 3 then 'incomplete' else 'none' end as problem,
       count(*) as n
from days group by 1
union all
select 'header', 1
"""

ORACLE: dict[str, str] = {
    "bars_by_month": bars_by("month", "%Y-%m"),
    "bars_by_year": bars_by("year", "%Y"),
    "bars_by_year_from_months": bars_by("year", "%Y"),
    "daily_bars_by_month": bars_by("month", "%Y-%m", source="days"),
    "daily_bars_by_year": bars_by("year", "%Y", source="days"),
    "month_bar_lookup": bars_by("month", "%Y-%m", "name = 'S7' and strftime(date, '%Y-%m') = '1998-06'"),
    "year_bar_lookup": bars_by("year", "%Y", "name = 'S7' and strftime(date, '%Y') = '1998'"),
    "asset_summary": summary(EXACT_MEAN),
    "formatted_summary": f"""{BARS}
select name, format('{{:,.2f}}', min(open)) as min_price_formatted,
       format('{{:,.2f}}', max(open)) as max_price_formatted
from bars group by name
""",
    "formatted_bars": f"""{BARS}
select name, strftime(date, '%Y-%m') as "month",
       {twelve_decimals("max(high)")} as highest_high_formatted,
       {twelve_decimals("arg_min(open, struct_pack(a := date, b := sno, c := open, d := close))")}
         as first_open_formatted
from bars group by all
""",
    "top_bars": top_bars("market_cap"),
    "top_bars_by_volume": top_bars("volume"),
    "top_bars_by_asset": top_bars_by_asset("market_cap"),
    "top_bars_by_asset_volume": top_bars_by_asset("volume"),
    "bars_by_month_of_runs": bars_by("month", "%Y-%m", source="days"),
    "bars_by_year_of_runs": bars_by("year", "%Y", source="days"),
    "csv_rejects": PROBLEMS,
    "job_bar_problems": f"select * from ({PROBLEMS}) where problem <> 'none'",
    "csv_bars": f"""{DAILY}
select sno as "SNo", name as "Name", symbol as "Symbol", date as "Date", high as "High", low as "Low",
       open as "Open", close as "Close", volume as "Volume", market_cap as "Marketcap" from days
""",
    "job_month_bars": bars_by("month", "%Y-%m", source="days"),
    "job_year_bars": bars_by("year", "%Y", source="days"),
    "job_asset_summary": summary(f"round({EXACT_MEAN}, 6)"),
    "job_top_bars": f"""
with ranked as ({top_bars("market_cap", "days")})
select * exclude (r) from (
  select *, row_number() over (
    partition by market_cap, name_coin
    order by symbol_coin desc, date desc, high desc, low desc, open desc, close desc, volume desc) as r
  from ranked
) where r = 1
""",
    "tick_metrics": f"{EXACT} select id, percent_volume, percent_market_cap, percent_change, cir_supply from metrics",
    "tick_metrics_decimal": f"""{EXACT}
select id,
       {six_decimals("volume * 10000", "total_24_volume * 100")} as percent_volume,
       {six_decimals("market_cap * 10000", "total_market_cap * 100")} as percent_market_cap,
       {six_decimals("(price - price_old) * 10000", "price_old * 100")} as percent_change,
       {six_decimals("market_cap * 100", "price * 100")} as cir_supply
from metrics
""",
    "live_prices": live_rows(EXACT),
    "snapshot_totals": EXACT + SNAPSHOT_TOTALS,
    "stream_snapshot_totals": SECONDS + SNAPSHOT_TOTALS,
    "latest_ticks": f"""{EXACT}
select symbol_coin, time_stamp, id, name_coin, cast(price as double) as price
from (select *, row_number() over (
        partition by symbol_coin order by time_stamp desc, id desc, name_coin desc, price desc) as r from ticks)
where r = 1
""",
    "price_history": PRICE_HISTORY,
    "price_history_by_day": PRICE_HISTORY,
    "rolling_stats": windows(EXACT, 300, 30),
    "rolling_stats_half_hourly": windows(EXACT, 21600, 1800),
    "rolling_stats_from_panes": windows(EXACT, 21600, 1800),
    "rolling_stats_uneven": windows(EXACT, 18000, 7200),
    "tumbling_stats": windows(EXACT, 86400, 86400, harmonic=True),
    "rolling_history": windows(EXACT, 300, 30, where="symbol_coin = 'click'") + "order by end_time desc",
    "top_winners": leaders(EXACT, "desc"),
    "top_losers": leaders(EXACT, "asc"),
    "ranked_winners": EXACT + RANKED,
    "stream_ranked_winners": SECONDS + RANKED,
    "market_share": share(EXACT),
    "latest_winners": newest_of_coin(
        "cast(price as double) as price, percent_change", "price desc, percent_change desc nulls last"
    )
    + "order by percent_change desc nulls last, name_coin limit 10",
    "latest_market_share": newest_of_coin(
        "percent_volume, percent_market_cap", "percent_volume desc nulls last, percent_market_cap desc nulls last"
    )
    + "order by percent_market_cap desc nulls last, name_coin limit 10",
    "tick_messages": f"{SECONDS} select id as key, {message_fields('time_stamp')} from metrics",
    "tick_rejects": REJECTS,
    "payload_coins": f"""{EXACT}
select {message_fields("fetched").replace("cast(price_old as double)", "cast(old as double)")}
from (
  select *, case when k % 3 > 1 then price_old else price end as old,
         date_trunc('second', max(time_stamp) over (partition by cast(time_stamp as date), event_id // 100)) as fetched
  from metrics
)
""",
    "payload_rejects": f"""{EXACT},
documents as (
  select count(*) as coins, cast(epoch(date_trunc('second', max(time_stamp))) as bigint) as fetched
  from ticks group by cast(time_stamp as date), event_id // 100
)
select 'document' as what, count(*) as n from documents where fetched % 4 = 1
union all
select 'coin', cast(sum(coins) as bigint) from documents where fetched % 4 = 2
""",
    "keyed_upsert": HOURLY_BATCHES,
    "keyed_upsert_compacted": HOURLY_BATCHES,
    "stored_price_history": f"""
select * from ({HOURLY_BATCHES}) where symbol_coin = 'view' and time_stamp < '2024-01-16' order by time_stamp desc
""",
    "stream_live_prices": newest_price(SECONDS, "1"),
    "stream_rolling_stats": windows(SECONDS, 300, 30),
    "stream_top_winners": leaders(SECONDS, "desc"),
    "stream_top_losers": leaders(SECONDS, "asc"),
    "stream_top_winners_batches": leaders(SECONDS, "desc"),
    "stream_market_share": share(SECONDS),
    "stream_market_share_batches": share(SECONDS),
    "stream_top_winners_kept": leaders(SECONDS, "desc"),
    "stream_top_losers_kept": leaders(SECONDS, "asc"),
    "stream_market_share_kept": share(SECONDS),
    "stream_landing": REJECTS,
    "stream_rolling_stats_panes": windows(SECONDS, 300, 30),
    "stream_on_time_stats": f"""{FED}
select symbol_coin,
       cast(sum(price) as double) / count(*) as arithmetic_mean,
       round(exp(avg(case when price > 0 then ln(cast(price as double)) end)), 6) as geometric_mean,
       round(stddev_samp(cast(price as double)), 6) as standard_deviation,
       start_time, end_time
from windowed where not missed group by symbol_coin, start_time, end_time
""",
    "stream_late_ticks": f"""{FED}
select id, time_stamp, high_water, count(*) filter (where missed) as missed_windows,
       case when bool_and(missed) then 'late' else 'late in part' end as reject_reason
from windowed group by all having bool_or(missed)
""",
    "stream_all": f"""{SECONDS}
select 'live_prices' as result, count(distinct (symbol_coin, time_stamp)) as n, max(time_stamp) as newest from ticks
union all
select 'rolling_stats', count(*), max(end_time) from ({windows(SECONDS, 300, 30)})
union all
select 'top_winners', count(*), max(time_stamp) from ({leaders(SECONDS, "desc")})
union all
select 'top_losers', count(*), max(time_stamp) from ({leaders(SECONDS, "asc")})
union all
select 'market_share', count(*), max(time_stamp) from ({share(SECONDS)})
""",
}
