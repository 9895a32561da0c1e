"""The same results in plain SQL (DuckDB), written independently of the library.

Rounding is the engine's ``round`` after a nudge of 1e-9, on both sides. Sums of rounded values go through whole
thousandths, so they do not depend on the order of addition.
"""

from __future__ import annotations

import re

from registry import fixtures

_NAMES = {n: n for n in ("events", "customer", "nation", "region", "orders")}
RUN_TS = "timestamp '2024-02-01 00:00:00'"

# each step may use the ones before it
STEPS = {
    "fx_readings": fixtures.READINGS.format(**_NAMES),
    "fx_sites": fixtures.SITES.format(**_NAMES),
    "fx_schedule": fixtures.SCHEDULE.format(**_NAMES),
    "clean": "select meter_id, date_trunc('minute', data_time) as data_time, import_active_power, src_id from fx_readings",
    "dedup": """
select * exclude (rn) from (
  select *, row_number() over (partition by meter_id, data_time order by import_active_power desc nulls last, src_id) as rn
  from clean) where rn = 1""",
    "bounded": """
select * exclude (rn) from (
  select *, row_number() over (partition by meter_id, data_time
    order by case when import_active_power between 0 and 1000000000 then import_active_power end desc nulls last, src_id) as rn
  from clean) where rn = 1""",
    "staged": """
select meter_id, data_time as reading_at,
  case when import_active_power > 1000000000 or import_active_power < 0 then null
       else round(import_active_power + 1e-9, 3) end as active_power_watts,
  cast(data_time as date) as reading_date,
  cast(hour(data_time) * 3600 + minute(data_time) * 60 + second(data_time) as int) as reading_time,
  year(data_time) || '-Q' || quarter(data_time) as quarter
from bounded""",
    "kept": "select * from staged where reading_date not between date '2024-01-10' and date '2024-01-15'",
    "sites": """
select meter_id, multiplication_factor, case when x is null or y is null then null else y end as lat,
  case when x is null or y is null then null else x end as lon, region, province, department_name, office_name
from (select meter_number as meter_id,
        coalesce(try_cast(nullif(trim(factor_text), '#') as double), 1.0) as multiplication_factor,
        try_cast(x_text as double) as x, try_cast(y_text as double) as y, region, province,
        department as department_name, office as office_name
      from fx_sites)""",
    "schedule": """
select cast(trim(split_part(replace(replace(coordinate, '(', ''), ')', ''), ',', 1)) as double) as lat,
  cast(trim(split_part(replace(replace(coordinate, '(', ''), ')', ''), ',', 2)) as double) as lon,
  coordinate as original_coordinate, cast(strptime(date_text, '%d-%m-%Y') as date) as date,
  cast(split_part(fajr, ':', 1) as int) * 3600 + cast(split_part(fajr, ':', 2) as int) * 60 as fajr_time,
  cast(split_part(dhuhr, ':', 1) as int) * 3600 + cast(split_part(dhuhr, ':', 2) as int) * 60 as dhuhr_time,
  15 * 3600 + 30 * 60 as asr_time, 18 * 3600 + 5 * 60 as maghrib_time,
  cast(split_part(isha, ':', 1) as int) * 3600 + cast(split_part(isha, ':', 2) as int) * 60 as isha_time
from fx_schedule""",
    "distances": """
select s.meter_id, s.multiplication_factor, s.lat as meter_lat, s.lon as meter_lon, s.region, s.province,
  l.original_coordinate as nearest_prayer_coordinate,
  2 * 6371010.0 * asin(sqrt(least(1.0, power(sin(radians(l.lat - s.lat) / 2), 2)
    + cos(radians(s.lat)) * cos(radians(l.lat)) * power(sin(radians(l.lon - s.lon) / 2), 2)))) as metres
from sites s cross join (select distinct original_coordinate, lat, lon from schedule) l""",
    "nearest": """
select meter_id, multiplication_factor, meter_lat, meter_lon, region, province, nearest_prayer_coordinate,
  case when meter_lat is null then null else round(metres + 1e-9) end as distance_meters, rn
from (select *, row_number() over (partition by meter_id
        order by case when meter_lat is not null then metres end nulls first, nearest_prayer_coordinate) as rn
      from distances) where rn = 1""",
    "joined": """
select r.meter_id, r.reading_at, r.active_power_watts, r.reading_date, r.reading_time, r.quarter,
  p.fajr_time, p.dhuhr_time, p.isha_time,
  cast((p.fajr_time + 100 * 60 + 86400) % 86400 as int) as morning_start_time,
  cast((p.dhuhr_time - 80 * 60 + 86400) % 86400 as int) as morning_end_time,
  cast((p.isha_time + 90 * 60 + 86400) % 86400 as int) as evening_start_time,
  cast((p.fajr_time - 80 * 60 + 86400) % 86400 as int) as evening_end_time
from {readings} r
left join nearest m on r.meter_id = m.meter_id
left join schedule p on month(r.reading_date) = month(p.date) and day(r.reading_date) = day(p.date)
  and m.nearest_prayer_coordinate = p.original_coordinate""",
    "flagged_readings": """
select *, coalesce(reading_time between morning_start_time and morning_end_time and dayofweek(reading_date) <> 5, false) as m,
  coalesce(reading_time >= evening_start_time or reading_time <= evening_end_time, false) as e
from joined""",
    "totals": """
select meter_id, sum(k) as t_sum, count(k) as t_n, sum(k) filter (m) as m_sum, count(k) filter (m) as m_n,
  sum(k) filter (e) as e_sum, count(k) filter (e) as e_n, min(reading_date) as min_reading_date,
  max(reading_date) as max_reading_date, count(morning_start_time) as readings_with_prayer_times, min(quarter) as quarter
from (select *, cast(floor(active_power_watts * 1000 + 0.5) as bigint) as k from flagged_readings)
group by meter_id""",
    "rounded": """
select meter_id,
  round(cast(t_sum as double) / cast(nullif(t_n * 1000, 0) as double) + 1e-9, 3) as total_avg_consumption,
  cast(t_sum as double) / 1000 as total_sum_consumption, t_n as total_reading_count,
  round(cast(m_sum as double) / cast(nullif(m_n * 1000, 0) as double) + 1e-9, 3) as morning_avg_consumption,
  cast(m_sum as double) / 1000 as morning_sum_consumption, m_n as morning_reading_count,
  round(cast(e_sum as double) / cast(nullif(e_n * 1000, 0) as double) + 1e-9, 3) as evening_avg_consumption,
  cast(e_sum as double) / 1000 as evening_sum_consumption, e_n as evening_reading_count,
  min_reading_date, max_reading_date, readings_with_prayer_times, quarter
from totals""",
    "consumption": """
select a.*, n.multiplication_factor, n.region, n.province,
  round((total_sum_consumption * multiplication_factor / 2e0) / 1e3 + 1e-9, 3) as total_energy_kwh,
  round((morning_sum_consumption * multiplication_factor / 2e0) / 1e3 + 1e-9, 3) as morning_energy_kwh,
  round((evening_sum_consumption * multiplication_factor / 2e0) / 1e3 + 1e-9, 3) as evening_energy_kwh,
  round((total_sum_consumption * multiplication_factor / 2e0) / 1e3 * 32e-2 + 1e-9, 3) as total_cost_sar,
  round((morning_sum_consumption * multiplication_factor / 2e0) / 1e3 * 32e-2 + 1e-9, 3) as morning_cost_sar,
  round((evening_sum_consumption * multiplication_factor / 2e0) / 1e3 * 32e-2 + 1e-9, 3) as evening_cost_sar,
  case when morning_avg_consumption is null and evening_avg_consumption is null then 'NO_PERIOD_DATA'
       when morning_avg_consumption is null then 'NO_MORNING_DATA'
       when evening_avg_consumption is null then 'NO_EVENING_DATA' else 'COMPLETE' end as data_quality_flag
from rounded a left join nearest n on a.meter_id = n.meter_id
where morning_avg_consumption is not null or evening_avg_consumption is not null""",
    "quality": """
select meter_id, min_date, max_date, date_range_days, expected_readings, actual_readings, zero_readings, null_readings,
  expected_readings - actual_readings as missing_readings,
  round(cast(actual_readings - zero_readings as double) / cast(expected_readings as double) * 100 + 1e-9, 2) as quality_percentage,
  cast(actual_readings - zero_readings as double) / cast(expected_readings as double) * 100 >= 50 as is_good_quality
from (select meter_id, min(reading_date) as min_date, max(reading_date) as max_date,
        date_diff('day', min(reading_date), max(reading_date)) as date_range_days,
        date_diff('day', min(reading_date), max(reading_date)) * 4 as expected_readings, count(*) as actual_readings,
        cast(sum(case when active_power_watts = 0 then 1 else 0 end) as bigint) as zero_readings,
        cast(sum(case when active_power_watts is null then 1 else 0 end) as bigint) as null_readings
      from staged group by meter_id) where expected_readings > 0""",
    "flagged": """
select c.meter_id, c.quarter, c.morning_avg_consumption, c.morning_sum_consumption, c.morning_reading_count,
  c.evening_avg_consumption, c.evening_sum_consumption, c.evening_reading_count, c.morning_energy_kwh,
  c.evening_energy_kwh, c.total_energy_kwh, c.morning_cost_sar, c.evening_cost_sar, c.total_cost_sar,
  c.multiplication_factor, c.region, c.province, c.min_reading_date, c.max_reading_date,
  q.quality_percentage, q.actual_readings, q.zero_readings, q.missing_readings, q.is_good_quality,
  c.morning_avg_consumption * c.multiplication_factor as morning_avg_mf,
  c.evening_avg_consumption * c.multiplication_factor as evening_avg_mf,
  case when c.morning_avg_consumption * c.multiplication_factor > 3000 then true else false end as over_in_morning,
  case when c.evening_avg_consumption * c.multiplication_factor > 3000 then true else false end as over_in_evening,
  case when c.morning_avg_consumption * c.multiplication_factor > 3000
        and c.evening_avg_consumption * c.multiplication_factor > 3000 then true else false end as over_in_both,
  case when c.morning_avg_consumption * c.multiplication_factor > 3000
        or c.evening_avg_consumption * c.multiplication_factor > 3000 then true else false end as over_in_either
from consumption c join quality q on c.meter_id = q.meter_id where q.is_good_quality""",
    "labelled": """
select *, case when over_in_both then 'BOTH_PERIODS' when over_in_morning then 'MORNING_ONLY'
  when over_in_evening then 'EVENING_ONLY' else 'COMPLIANT' end as violation_category from flagged""",
    "violators": """
select *, potential_savings_morning_sar + potential_savings_evening_sar as total_potential_savings_sar
from (select * exclude (is_good_quality),
        case when over_in_morning then round((morning_avg_mf - 500) * morning_reading_count / 2e0 / 1e3 * 32e-2 + 1e-9, 3)
          else 0.0e0 end as potential_savings_morning_sar,
        case when over_in_evening then round((evening_avg_mf - 500) * evening_reading_count / 2e0 / 1e3 * 32e-2 + 1e-9, 3)
          else 0.0e0 end as potential_savings_evening_sar
      from labelled where over_in_either)""",
    "regional": "select * from flagged where region = 'ASIA' and province like '%NATION_1%'",
    "daily_runs": """
select 'run_' || strftime(i.day, '%Y%m%d') as run_id, cast(i.day as timestamp) as run_timestamp, 'all_files' as source_filename,
  cast(null as varchar) as quarter, 'staging' as stage_name, rows_input, rows_output, rows_input - rows_output as rows_filtered,
  cast(null as varchar) as filter_reason, unique_meters, min_reading_date, max_reading_date,
  cast(null as double) as processing_seconds, cast(null as bigint) as file_size_bytes,
  cast(null as bigint) as rows_with_null_power, cast(null as bigint) as rows_with_zero_power,
  cast(null as bigint) as rows_duplicates_skipped, 'success' as status, cast(null as varchar) as error_message
from (select cast(data_time as date) as day, count(*) as rows_input from clean group by 1) i
join (select reading_date as day, count(*) as rows_output, count(distinct meter_id) as unique_meters,
        min(reading_date) as min_reading_date, max(reading_date) as max_reading_date from staged group by 1) o on i.day = o.day""",
}


def _sql(final: str, readings: str = "staged", **extra: str) -> str:
    """A query with the steps it needs, found by name."""
    steps = {**{name: text.strip() for name, text in STEPS.items()}, **extra}
    steps["joined"] = steps["joined"].replace("{readings}", readings)
    order: list[str] = []

    def need(text: str) -> None:
        for name in steps:
            if name not in order and re.search(rf"\b(from|join)\s+{name}\b", text):
                need(steps[name])
                order.append(name)

    need(final)
    return ("with " + ",\n".join(f"{n} as ({steps[n]})" for n in order) + "\n" if order else "") + final


def _stats_row(columns: dict[str, str]) -> str:
    """All statistics columns, null unless given."""
    types = {
        "run_id": "varchar", "run_timestamp": "timestamp", "source_filename": "varchar", "quarter": "varchar",
        "stage_name": "varchar", "rows_input": "bigint", "rows_output": "bigint", "rows_filtered": "bigint",
        "filter_reason": "varchar", "unique_meters": "bigint", "min_reading_date": "date", "max_reading_date": "date",
        "processing_seconds": "double", "file_size_bytes": "bigint", "rows_with_null_power": "bigint",
        "rows_with_zero_power": "bigint", "rows_duplicates_skipped": "bigint", "status": "varchar", "error_message": "varchar",
    }
    return ", ".join(f"cast({columns.get(n, 'null')} as {t}) as {n}" for n, t in types.items())


_RUN = {"run_id": "'run_1'", "run_timestamp": RUN_TS, "source_filename": "'all_files'", "status": "'success'"}

_HWM_FIRST = "select * from staged where reading_date < date '2024-01-30'"


def _incremental() -> str:
    """Rows of the first build for meters without a newer reading, rebuilt rows for the others."""
    build = _sql("select * from consumption")
    first = _sql("select * from consumption", readings="first_part", first_part=_HWM_FIRST)
    # the steps of both builds are nested, each under its own name
    changed = _sql(
        "select meter_id from staged where reading_date > (select max(reading_date) from first_part)", first_part=_HWM_FIRST
    )
    return (
        f"select * from ({build}) where meter_id in ({changed}) union all "
        f"select * from ({first}) where meter_id not in ({changed})"
    )


def _csv_rows() -> str:
    return """
select meter_id as "METER_ID", date_trunc('minute', data_time) as "DATA_TIME", import_active_power as "IMPORT_ACTIVE_POWER",
  strftime(date_trunc('minute', data_time), '%Y-%m-%d %H:%M:%S') as "DATA_TIME_STR",
  year(data_time) || '-Q' || quarter(data_time) as "QUARTER"
from fx_readings cross join (select unnest([0, 1, 2, 3, 4, 5]) as layout)"""


ORACLES = {
    "stage_readings": _sql("select * from staged"),
    "dedup_latest": _sql("select * from dedup"),
    "outlier_mask": _sql(
        "select src_id, case when import_active_power > 1000000000 or import_active_power < 0 then null "
        "else round(import_active_power + 1e-9, 3) end as active_power_watts from fx_readings"
    ),
    "exclude_dates": _sql("select * from kept"),
    "exclusion_stats": _sql(
        "select "
        + _stats_row(
            {
                **_RUN,
                "stage_name": "'ramadan_filter'",
                "rows_input": "(select count(*) from staged)",
                "rows_output": "(select count(*) from kept)",
                "rows_filtered": "(select count(*) from staged where reading_date between date '2024-01-10' and date '2024-01-15')",
                "filter_reason": "case when (select count(*) from staged where reading_date between date '2024-01-10' and date '2024-01-15') > 0 "
                "then 'ramadan_dates_2024-01-10_to_2024-01-15' else 'no_ramadan_filter_active' end",
                "unique_meters": "(select count(distinct meter_id) from kept)",
                "min_reading_date": "(select min(reading_date) from kept)",
                "max_reading_date": "(select max(reading_date) from kept)",
            }
        )
    ),
    "staging_stats": _sql(
        "select "
        + _stats_row(
            {
                **_RUN,
                "stage_name": "'staging'",
                "rows_input": "(select count(*) from clean)",
                "rows_output": "(select count(*) from staged)",
                "rows_filtered": "(select count(*) from clean) - (select count(*) from staged)",
                "filter_reason": "'dedup_and_outliers'",
                "unique_meters": "(select count(distinct meter_id) from staged)",
                "min_reading_date": "(select min(reading_date) from staged)",
                "max_reading_date": "(select max(reading_date) from staged)",
                "rows_with_null_power": "(select sum(case when active_power_watts is null then 1 else 0 end) from staged)",
                "rows_with_zero_power": "(select sum(case when active_power_watts = 0 then 1 else 0 end) from staged)",
            }
        )
    ),
    "stage_sites": _sql("select * from sites"),
    "stage_schedule": _sql("select * from schedule"),
    "parse_timestamps": """
select event_id, text, data_time, strftime(data_time, '%Y-%m-%d %H:%M:%S') as data_time_str,
  year(data_time) || '-Q' || quarter(data_time) as quarter, case when event_type = 'click' then null else value end as power
from (select event_id, event_type, value,
  case event_type when 'view' then strftime(ts, '%Y-%m-%d %H:%M:%S') || '.4600000' when 'click' then strftime(ts, '%Y-%m-%d')
    when 'purchase' then strftime(ts, '%d/%m/%Y %H:%M') else strftime(ts, '%Y-%m-%d %H:%M:%S') end as text,
  case event_type when 'click' then date_trunc('day', ts) when 'purchase' then null else date_trunc('minute', ts) end as data_time
  from events)""",
    "row_key": _sql(
        "select meter_id, meter_id as other_meter_id, data_time, data_time as other_data_time, count(*) as n "
        "from clean group by meter_id, data_time"
    ),
    "nearest_location": _sql("select * from nearest"),
    "nearest_location_cells": _sql("select * from nearest"),
    "attach_periods": _sql("select * from joined"),
    "attach_periods_salted": _sql("select * from joined"),
    "period_flags": _sql("select meter_id, reading_at, m as in_morning, e as in_evening from flagged_readings"),
    "schedule_repeats": "select original_coordinate, month(date) as month, day(date) as day, count(*) as n from ("
    + fixtures.YEARS.format(**_NAMES)
    + ") group by 1, 2, 3 having count(*) > 1",
    "consumption": _sql("select * from consumption"),
    "consumption_excluding": _sql("select * from consumption", readings="kept"),
    "meter_quality": _sql("select * from quality"),
    "flag_over": _sql(
        "select meter_id, morning_avg_mf, evening_avg_mf, over_in_morning, over_in_evening, over_in_both, over_in_either, "
        "violation_category from labelled"
    ),
    "violators": _sql("select * from violators"),
    "regional_consumption": _sql("select * from regional"),
    "regional_violators": _sql(
        "select *, sum(case when over_in_morning then 1 else 0 end) over ()::bigint as total_overs_morning, "
        "sum(case when over_in_evening then 1 else 0 end) over ()::bigint as total_overs_evening, "
        "sum(case when over_in_both then 1 else 0 end) over ()::bigint as total_overs_both, "
        "sum(case when over_in_either then 1 else 0 end) over ()::bigint as total_overs_either, "
        "count(*) over () as total_violators_riyadh from regional where over_in_either"
    ),
    "regional_report": _sql(
        """
select (select count(distinct q.meter_id) from quality q join nearest n on q.meter_id = n.meter_id
        where n.region = 'ASIA' and n.province like '%NATION_1%') as total_meters_before_quality_filter,
  count(distinct meter_id) as total_meters_after_quality_filter,
  count(*) filter (over_in_morning) as overs_morning, count(*) filter (over_in_evening) as overs_evening,
  count(*) filter (over_in_both) as overs_both, count(*) filter (over_in_either) as overs_either,
  round(cast(sum(case when over_in_morning then cast(morning_energy_kwh as decimal(20,3)) else 0 end)
    + sum(case when over_in_evening then cast(evening_energy_kwh as decimal(20,3)) else 0 end) as double) / 1e6 + 1e-9, 2)
    as over_consumers_gwh,
  round(cast(sum(case when over_in_morning then cast(morning_cost_sar as decimal(20,3)) else 0 end)
    + sum(case when over_in_evening then cast(evening_cost_sar as decimal(20,3)) else 0 end) as double) / 1e6 + 1e-9, 2)
    as over_consumers_cost_million_sar,
  round(cast(sum(case when not over_in_morning then cast(morning_energy_kwh as decimal(20,3)) else 0 end)
    + sum(case when not over_in_evening then cast(evening_energy_kwh as decimal(20,3)) else 0 end) as double) / 1e6 + 1e-9, 2)
    as regular_consumers_gwh,
  round(cast(sum(case when not over_in_morning then cast(morning_cost_sar as decimal(20,3)) else 0 end)
    + sum(case when not over_in_evening then cast(evening_cost_sar as decimal(20,3)) else 0 end) as double) / 1e6 + 1e-9, 2)
    as regular_consumers_cost_million_sar,
  14094 as team_total_meters_before, 12673 as team_total_meters_after, 6591 as team_overs_morning, 7027 as team_overs_evening,
  5959 as team_overs_both, 7659 as team_overs_either, 60.34e0 as team_over_consumers_gwh,
  19.31e0 as team_over_consumers_cost_million_sar, 6.42e0 as team_regular_consumers_gwh,
  2.06e0 as team_regular_consumers_cost_million_sar
from regional"""
    ),
    "daily_usage": _sql(
        """
select meter_id, reading_date as date, year(reading_date) || '-Q' || quarter(reading_date) as quarter,
  round(cast(sum(cast(floor(active_power_watts * 1000 + 0.5) as bigint)) as double)
    / cast(nullif(count(active_power_watts) * 1000, 0) as double) + 1e-9, 3) as avg_daily_power_watts,
  max(active_power_watts) as max_daily_power_watts, min(active_power_watts) as min_daily_power_watts, count(*) as readings_count
from staged group by meter_id, reading_date"""
    ),
    "region_summary": _sql(
        """
select region, count(*) as meter_count,
  round(cast(sum(cast(total_avg_consumption as decimal(20,3))) as double) / count(total_avg_consumption) + 1e-9, 2) as avg_consumption_w,
  round(cast(sum(cast(total_energy_kwh as decimal(20,3))) as double) + 1e-9, 2) as total_energy_kwh,
  round(cast(sum(cast(total_cost_sar as decimal(20,3))) as double) + 1e-9, 2) as total_cost_sar
from consumption group by region"""
    ),
    "top_violators": _sql(
        "select meter_id, violation_category, morning_avg_mf as morning_watts, evening_avg_mf as evening_watts, "
        "total_potential_savings_sar from violators where over_in_both order by total_potential_savings_sar desc, meter_id limit 20"
    ),
    "top_complete": _sql(
        "select * from consumption where data_quality_flag = 'COMPLETE' order by total_energy_kwh desc nulls last, meter_id limit 10"
    ),
    "insert_if_absent": _sql(
        "select meter_id, data_time, import_active_power, src_id, cast(data_time as date) as reading_date from clean"
    ),
    "upsert_by_key": """
with old as (select cast(user_id as varchar) as meter_id, count(*) as n, min(ts) as first_ts from events
             where cast(ts as date) < date '2024-01-29' group by 1),
     new as (select cast(user_id as varchar) as meter_id, count(*) as n, min(ts) as first_ts, max(value) as max_value from events
             where cast(ts as date) >= date '2024-01-29' group by 1)
select meter_id, n, first_ts, cast(null as double) as max_value from old where meter_id not in (select meter_id from new)
union all select * from new""",
    "changed_meters": _sql("select distinct meter_id from staged where reading_date > date '2024-01-29'"),
    "readings_of_changed_meters": _sql(
        "select * from staged where meter_id in (select meter_id from staged where reading_date > date '2024-01-29')"
    ),
    "new_pairs": """
select cast(o_custkey as varchar) as meter_id, year(o_orderdate) || '-Q' || quarter(o_orderdate) as quarter, count(*) as n
from orders group by 1, 2 having count(*) filter (o_orderpriority = '1-URGENT') = 0""",
    "incremental_consumption": _incremental(),
    "insert_if_absent_hash": _sql(
        """
select meter_id as "METER_ID", data_time as "DATA_TIME", import_active_power as "IMPORT_ACTIVE_POWER", src_id,
  cast(data_time as date) as reading_date
from (select case when src_id % 50 <> 0 then meter_id end as meter_id, case when src_id % 70 <> 0 then data_time end as data_time,
        import_active_power, src_id from clean) r"""
    ),
    "latest_run_stats": _sql("select * from daily_runs where run_id = (select max(run_id) from daily_runs)"),
    "filter_effectiveness": _sql(
        "select cast(run_timestamp as date) as run_date, stage_name, cast(sum(rows_input) as bigint) as total_input, "
        "cast(sum(rows_filtered) as bigint) as total_filtered, "
        "round(cast(sum(rows_filtered) as double) / cast(sum(rows_input) as double) * 100 + 1e-9, 2) as filter_pct "
        "from daily_runs group by 1, 2"
    ),
    "run_not_in": _sql(
        "select * from daily_runs where run_id not in (select run_id from daily_runs where run_timestamp < timestamp '2024-01-20')"
    ),
    "run_not_in_null": _sql(
        "select * from daily_runs where run_id not in "
        "(select case when run_timestamp >= timestamp '2024-01-20' then run_id end from daily_runs)"
    ),
    "stats_json": _sql("select * from daily_runs"),
    "stats_table": _sql("select * from daily_runs"),
    "reference_load": _sql(
        """
select meter_number as "METER_NUMBER", factor_text as "MULTIPLICATION_FACTOR", x_text as "X_COORDINATES", cast(y_text as double) as "Y_COORDINATES",
  region as "REGION", province as "PROVINCE", department as "DEPARTMENT_NAME", office as "OFFICE_NAME", true as "HAS_LOAD_TIME"
from fx_sites"""
    ),
    "load_counts": _sql(
        """
select load, rows_input, rows_inserted, rows_input - rows_inserted as rows_skipped, 2 * n as rows_in_table, n as rows_with_key
from (select count(*) as n, count(*) filter (data_time < timestamp '2024-01-20') as early from clean) c,
  lateral (values (0, early, early), (1, n, n - early), (2, n, n)) v(load, rows_input, rows_inserted)"""
    ),
    "proposed_mapping": _sql(
        """
select v.*, case when kind = 'required' then n end as n_rows
from (values (0, 'required', null, 0, 2),
       (1, 'reject', 'no column for METER_ID, ID, METER_NO, IMPORT_ACTIVE_POWER, IMPORT_REACTIVE_POWER, IMPORT_APPARENT_POWER, '
        || 'REACTIVE_POWER_IMPORT, EXPORT_ACTIVE_POWER, EXPORT_REACTIVE_POWER, EXPORT_APPARENT_POWER, REACTIVE_POWER_EXPORT, '
        || 'IMPORT_FACTOR_POWER, EXPORT_FACTOR_POWER, STATUS', null, null),
       (2, 'reject', 'names repeat after mapping', null, null)) v("case", kind, problem, meter_position, power_position)
cross join (select cast(count(*) as bigint) as n from fx_readings) c"""
    ),
    "unhashed_run": _sql(
        """
select meter_id as "METER_ID", date_trunc('minute', data_time) as "DATA_TIME", import_active_power as "IMPORT_ACTIVE_POWER",
  strftime(date_trunc('minute', data_time), '%Y-%m-%d %H:%M:%S') as "DATA_TIME_STR",
  year(data_time) || '-Q' || quarter(data_time) as "QUARTER"
from fx_readings"""
    ),
    "file_profile": "select "
    + _stats_row(
        {
            **_RUN,
            "source_filename": "event_type || '.csv'",
            "stage_name": "'etl'",
            "rows_input": "count(*)",
            "rows_output": "count(*)",
            "rows_filtered": "0",
            "unique_meters": "count(distinct user_id)",
            "min_reading_date": "min(ts)",
            "max_reading_date": "max(ts)",
            "file_size_bytes": "sum(length(props))",
            "rows_with_null_power": "count(*) filter (value > 200)",
            "rows_with_zero_power": "count(*) filter (value = 0)",
        }
    )
    + " from events group by event_type",
    "unique_check": _sql("select meter_id, data_time, count(*) as n_records from clean group by 1, 2 having count(*) > 1"),
    "not_null_check": _sql(
        "select * from (select 'meter_id' as column_name, count(*) filter (meter_id is null) as n_nulls from clean "
        "union all select 'data_time', count(*) filter (data_time is null) from clean "
        "union all select 'import_active_power', count(*) filter (import_active_power is null) from clean) where n_nulls > 0"
    ),
    "table_checks_broken": _sql(
        """
select 'clean.unique.row_hash' as check_name, count(*) as n_violations
  from (select meter_id, data_time from clean where src_id % 100 <> 0 group by 1, 2 having count(*) > 1)
union all select 'clean.not_null.row_hash', count(*) filter (src_id % 100 = 0) from clean
union all select 'clean.not_null.meter_id', count(*) filter (meter_id is null) from clean
union all select 'clean.not_null.data_time', count(*) filter (data_time is null) from clean
union all select 'consumption.unique.meter_id', count(*) filter (meter_id like '1%') from consumption
union all select 'consumption.not_null.meter_id', count(*) filter (meter_id is null) from consumption
union all select 'daily.unique.meter_id.date', count(distinct (meter_id, reading_date)) filter (day(reading_date) = 3) from staged
union all select 'daily.not_null.meter_id', count(*) filter (meter_id is null) from staged
union all select 'daily.not_null.date', count(distinct (meter_id, reading_date)) filter (day(reading_date) = 5) from staged"""
    ),
    "table_checks": _sql(
        """
select 'clean.unique.row_hash' as check_name, count(*) as n_violations
  from (select meter_id, data_time from clean group by 1, 2 having count(*) > 1)
union all select 'clean.not_null.row_hash', count(*) filter (meter_id is null and data_time is null) from clean
union all select 'clean.not_null.meter_id', count(*) filter (meter_id is null) from clean
union all select 'clean.not_null.data_time', count(*) filter (data_time is null) from clean
union all select 'consumption.unique.meter_id', count(*) - count(distinct meter_id) from consumption
union all select 'consumption.not_null.meter_id', count(*) filter (meter_id is null) from consumption
union all select 'daily.unique.meter_id.date', count(*) filter (n > 1) from (
  select meter_id, reading_date, count(*) as n from (select distinct meter_id, reading_date from staged) group by 1, 2)
union all select 'daily.not_null.meter_id', count(*) filter (meter_id is null) from staged
union all select 'daily.not_null.date', count(*) filter (reading_date is null) from staged"""
    ),
    "run_checks": _sql(
        """
select 'readings.unique.meter_id.data_time' as check_name, count(*) as n_violations
  from (select meter_id, data_time from clean group by 1, 2 having count(*) > 1)
union all select 'readings.not_null.row_hash', 0
union all select 'readings.not_null.meter_id', count(*) filter (meter_id is null) from clean
union all select 'readings.not_null.data_time', count(*) filter (data_time is null) from clean
union all select 'consumption.unique.meter_id', count(*) - count(distinct meter_id) from consumption
union all select 'consumption.not_null.meter_id', count(*) filter (meter_id is null) from consumption
union all select 'daily.unique.meter_id.date', count(*) filter (n > 1) from (
  select meter_id, reading_date, count(*) as n from (select distinct meter_id, reading_date from staged) group by 1, 2)
union all select 'daily.not_null.meter_id', count(*) filter (meter_id is null) from staged
union all select 'daily.not_null.date', count(*) filter (reading_date is null) from staged"""
    ),
    "csv_harmonised": _sql(_csv_rows()),
    "header_mapping": _sql(
        """
select layout, separator, headers, kind, meter_position, time_position, power_position, n_rows, n_meters
from (values (0, ',', 'meter_id id meter_no data_time import_active_power import_reactive_power import_apparent_power reactive_power_import '
        || 'export_active_power export_reactive_power export_apparent_power reactive_power_export import_factor_power export_factor_power status',
        'full', 0, 3, 4),
       (1, ';', 'Reading_DateTime MTR_ID note ACTIVE_POWER', 'required', 1, 0, 3),
       (2, chr(9), 'METER IMPORT_POWER TIMESTAMP', 'required', 0, 2, 1),
       (3, '|', 'STATUS DT METERID KW_IMP', 'required', 2, 1, 3),
       (4, ',', ' METER_ID note, free DATA_TIME IMPORT_ACTIVE_POWER', 'required', 1, 3, 4),
       (5, ';', 'METER_ID  DATA_TIME IMPORT_ACTIVE_POWER ', 'required', 0, 2, 3))
  v(layout, separator, headers, kind, meter_position, time_position, power_position)
cross join (select count(*) as n_rows, count(distinct meter_id) as n_meters from fx_readings) c"""
    ),
    "stream_ingest": _sql(
        'select meter_id as "METER_ID", data_time as "DATA_TIME", import_active_power as "IMPORT_ACTIVE_POWER", '
        "year(data_time) || '-Q' || quarter(data_time) as \"QUARTER\" from dedup"
    ),
    "file_stats_run": _sql(
        """
select 'etl' as stage_name, 'success' as status, cast(null as varchar) as error_message, cast(6 * count(*) as bigint) as rows_input,
  cast(6 * count(*) as bigint) as rows_output, cast(0 as bigint) as rows_filtered, min(cast(data_time as date)) as min_reading_date,
  max(cast(data_time as date)) as max_reading_date, cast(6 * count(*) filter (import_active_power is null) as bigint) as rows_with_null_power,
  cast(6 * count(*) filter (import_active_power = 0) as bigint) as rows_with_zero_power
from fx_readings
union all select 'etl', 'failed', 'no column for METER_ID, IMPORT_ACTIVE_POWER', 0, null, null, null, null, null, null"""
    ),
    "broken_lines_run": _sql(
        """
select 'success' as status, count(*) as rows_input, count(*) filter (src_id % 7 <> 0) as rows_output,
  count(*) filter (src_id % 7 = 0) as rows_filtered, 'date_parse_failures' as filter_reason,
  count(distinct meter_id) filter (src_id % 7 <> 0) as unique_meters,
  count(*) filter (src_id % 7 <> 0 and (src_id % 11 = 0 or import_active_power is null)) as rows_with_null_power,
  count(*) filter (src_id % 7 <> 0 and src_id % 11 <> 0 and import_active_power = 0) as rows_with_zero_power
from fx_readings"""
    ),
    "gated_run": _sql(
        """
select meter_id as "METER_ID", date_trunc('minute', data_time) as "DATA_TIME",
  case when src_id % 11 <> 0 then import_active_power end as "IMPORT_ACTIVE_POWER", year(data_time) || '-Q' || quarter(data_time) as "QUARTER"
from fx_readings where src_id % 7 <> 0"""
    ),
    "mixed_batches": _sql(
        """
select src_id, meter_id, data_time, case src_id % 4 when 1 then trunc(import_active_power) when 3 then null else import_active_power end
    as import_active_power, case when src_id % 4 = 1 then 'ok' end as status, case when src_id % 4 = 3 then 7 end as note,
  cast(data_time as date) as reading_date, src_id % 4 <> 2 as has_key
from clean"""
    ),
    "whole_run": _sql("select * from violators"),
    "whole_run_twice": _incremental(),
    "models_in_sql": _sql(
        """
select c.region, count(*) as meters, sum(d.days)::bigint as days, sum(d.readings)::bigint as readings, max(d.peak) as peak
from consumption c join (select meter_id, count(distinct reading_date) as days, count(*) as readings, max(active_power_watts) as peak
  from staged group by meter_id) d on d.meter_id = c.meter_id group by c.region"""
    ),
}
