"""Inputs derived from whole given tables.

Each text is valid in Spark SQL (tables passed as ``{name}`` arguments) and in DuckDB (names filled in).
"""

# Two copies of every event: the second lacks power where the first has zero, so deduplication has
# real choices; large values turn negative and get masked.
READINGS = """
select cast(user_id as string) as meter_id, ts as data_time,
  case when value > 200 then -value when value < 1 then 0.0 else value end as import_active_power,
  event_id as src_id
from {events}
union all
select cast(user_id as string), ts,
  case when value > 200 then -value when value < 1 then null else value end,
  event_id + 1000000000
from {events}
"""

# One site per customer: '#' and padded factors, unusable longitudes, some ids no meter has.
SITES = """
select case when c_custkey % 31 = 7 then 'S' else '' end || cast(c_custkey as string) as meter_number,
  case c_custkey % 5 when 0 then '#' when 1 then '1' when 2 then '60' when 3 then ' 120 ' else '160' end as factor_text,
  case when c_custkey % 23 = 0 then 'n/a' else cast(35 + (c_custkey * 37) % 20 as string) || '.5' end as x_text,
  cast(17 + (c_custkey * 53) % 15 as string) || '.25' as y_text,
  r_name as region, n_name as province, c_mktsegment as department, c_name as office
from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
"""

# One location per nation; a calendar day for every day of month on which the nation ordered.
# The year differs from the readings' year; late evening times wrap past midnight.
SCHEDULE = """
select '(' || cast(17 + (n_nationkey % 5) * 3 as string) || '.5, '
    || cast(35 + cast(floor(n_nationkey / 5) as int) * 4 as string) || '.75)' as coordinate,
  lpad(cast(d as string), 2, '0') || '-01-2023' as date_text,
  lpad(cast(cast(floor(f / 60) as int) as string), 2, '0') || ':' || lpad(cast(f % 60 as string), 2, '0') as fajr,
  lpad(cast(cast(floor(z / 60) as int) as string), 2, '0') || ':' || lpad(cast(z % 60 as string), 2, '0') as dhuhr,
  lpad(cast(cast(floor(i / 60) as int) as string), 2, '0') || ':' || lpad(cast(i % 60 as string), 2, '0') as isha
from (
  select distinct n_nationkey, extract(day from o_orderdate) as d, 280 + (n_nationkey % 5) * 4 as f,
    720 + cast(floor(n_nationkey / 5) as int) * 3 as z, 1150 + n_nationkey * 9 as i
  from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
) days
"""

# The same locations, one row per real order date: several years repeat a calendar day.
YEARS = """
select distinct '(' || cast(17 + (n_nationkey % 5) * 3 as string) || '.5, '
    || cast(35 + cast(floor(n_nationkey / 5) as int) * 4 as string) || '.75)' as original_coordinate,
  cast(o_orderdate as date) as date
from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
"""
