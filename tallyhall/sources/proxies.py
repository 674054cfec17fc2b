"""Reference-shaped inputs as projections of the driver's tables.

Plain SQL that Spark and DuckDB both run; ``{name}`` marks a driver table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Given, so that no job has to read file footers before a plan can be made.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
}

VIEWS = {
    "warehouse_metering_history": """
select concat('ORG', cast(user_id % 2 as string)) as organization_name,
       concat('ACCT', cast(user_id % 5 as string)) as account_name,
       concat('WH_', event_type) as warehouse_name,
       ts as start_time, ts + interval 1 hour as end_time,
       value as credits_used, value * 0.9 as credits_used_compute,
       value * 0.1 as credits_used_cloud_services
from {events}""",
    "metering_daily_history": """
select concat('ORG', cast(user_id % 2 as string)) as organization_name,
       concat('ACCT', cast(user_id % 5 as string)) as account_name,
       cast(ts as date) as usage_date,
       case event_type when 'error' then 'AI_SERVICES' else 'WAREHOUSE_METERING' end as service_type,
       value as credits_used, value * 0.9 as credits_used_compute,
       value * 0.1 as credits_used_cloud_services,
       value * -0.05 as credits_adjustment_cloud_services, value * 0.95 as credits_billed
from {events}""",
    "pipe_usage_history": """
select concat('ORG', cast(user_id % 2 as string)) as organization_name,
       concat('ACCT', cast(user_id % 5 as string)) as account_name,
       concat('PIPE_', cast(user_id % 10 as string)) as pipe_name,
       cast(ts as date) as usage_date,
       user_id * 100 as bytes_inserted, 1 as files_inserted, value as credits_used
from {events}""",
    "storage_daily_history": """
select concat('ORG', cast(o_custkey % 2 as string)) as organization_name,
       concat('ACCT', cast(o_custkey % 5 as string)) as account_name,
       cast(o_orderdate as date) as usage_date, o_orderpriority as service_type,
       o_totalprice as average_bytes, o_totalprice / 100000 as credits
from {orders}""",
    "stage_storage_usage_history": """
select concat('ORG', cast(o_custkey % 2 as string)) as organization_name,
       concat('ACCT', cast(o_custkey % 5 as string)) as account_name,
       cast(o_orderdate as date) as usage_date, o_totalprice as average_stage_bytes
from {orders}""",
    "database_storage_usage_history": """
select concat('ORG', cast(o_custkey % 2 as string)) as organization_name,
       concat('ACCT', cast(o_custkey % 5 as string)) as account_name,
       o_orderpriority as database_name, cast(o_orderdate as date) as usage_date,
       o_totalprice * 0.1 as average_hybrid_table_storage_bytes,
       o_totalprice as average_database_bytes, o_totalprice * 0.2 as average_failsafe_bytes
from {orders}""",
    "data_transfer_history": """
select concat('ORG', cast(l_suppkey % 2 as string)) as organization_name,
       concat('ACCT', cast(l_suppkey % 5 as string)) as account_name,
       cast(l_shipdate as date) as usage_date,
       l_returnflag as source_cloud, l_linestatus as source_region,
       concat('C', cast(l_linenumber % 2 as string)) as target_cloud,
       concat('R', cast(l_suppkey % 3 as string)) as target_region,
       l_extendedprice as bytes_transferred
from {lineitem}""",
    "automatic_clustering_history": """
select concat('ORG', cast(l_suppkey % 2 as string)) as organization_name,
       concat('ACCT', cast(l_suppkey % 5 as string)) as account_name,
       l_returnflag as database_name, l_linestatus as schema_name,
       nullif(concat('T', cast(l_partkey % 20 as string)), 'T7') as table_name,
       cast(l_shipdate as date) as usage_date, l_quantity as credits_used,
       l_linenumber as num_rows_reclustered, l_extendedprice as num_bytes_reclustered
from {lineitem}""",
    "materialized_view_refresh_history": """
select concat('ORG', cast(l_suppkey % 2 as string)) as organization_name,
       concat('ACCT', cast(l_suppkey % 5 as string)) as account_name,
       l_returnflag as database_name, l_linestatus as schema_name,
       nullif(concat('MV', cast(l_partkey % 20 as string)), 'MV7') as table_name,
       cast(l_shipdate as date) as usage_date, l_quantity / 10 as credits_used
from {lineitem}""",
    "purchases_landed": """
select o_orderkey as seq,
       concat('''', cast(o_orderkey % 21 as string)) as purchase_document,
       case when o_custkey % 10 = 0 then cast(o_custkey % 1000 as string)
            else lpad(cast((o_custkey * 7) % 10000 as string), 4, '0') end as department,
       concat('Dept ', cast(o_custkey as string)) as department_name,
       o_orderpriority as first_item_title,
       concat('''', cast(o_custkey as string)) as supplier_id,
       concat('Supplier ', cast(o_custkey as string)) as supplier_name,
       concat(cast(month(o_orderdate) as string), '/', cast(day(o_orderdate) as string), '/',
              cast(year(o_orderdate) as string)) as start_date,
       case when o_orderkey % 50 = 0 then '13/40/2024'
            else concat(cast(month(o_orderdate) as string), '/', cast(day(o_orderdate) as string), '/',
                        cast(year(o_orderdate) + 1 as string)) end as end_date,
       concat('$', cast(cast(o_totalprice as decimal(18,2)) as string)) as grand_total,
       concat('''', cast(o_orderkey as string)) as associated_pos,
       cast(o_custkey % 100 as string) as lpa_contract_id,
       case when o_orderkey % 2 = 0 then 'IT Goods' else 'IT Services' end as acquisition_type
from {orders}""",
    "contracts_landed": """
select s_name as contract_id, concat('Contract ', s_name) as contract_description,
       cast(s_suppkey as string) as supplier_id, s_name as supplier_name,
       case when s_suppkey % 4 = 0 then 'nan' else concat('Buyer ', cast(s_suppkey as string)) end as buyer,
       date '2024-01-01' as begin_date, date '2025-01-01' as expire_date,
       'Statewide' as contract_type,
       case when s_suppkey % 3 = 0 then 'nan' else 'SB' end as certification_type,
       'IT Goods' as acquisition_type,
       case when s_suppkey % 2 = 0 then 'active' else 'expired' end as status
from {supplier}""",
    "base_entities": """
select cast(r_regionkey * 10 as string) as a, cast(null as string) as b, cast(null as string) as l1,
       cast(null as string) as l2, cast(null as string) as l3, concat('Agency of ', r_name) as name
from {region}
union all
select cast(n_regionkey * 10 as string), cast(100 + n_nationkey as string), cast(null as string),
       cast(null as string), cast(null as string),
       case when n_nationkey % 5 = 0 then concat('no subagency ', n_name, ' do not use')
            else concat('Board of ', n_name) end
from {nation}
union all
select cast(n_regionkey * 10 as string), cast(100 + n_nationkey as string),
       cast(8950 + s_suppkey as string), cast(null as string), cast(null as string),
       concat('Department of ', s_name,
              case s_suppkey % 6 when 0 then ' (Old)' when 1 then ' -- DO NOT USE'
                   when 2 then ' - DOF USE ONLY' when 3 then ' (Abolished)' else '' end)
from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "budgets": """
select cast(8950 + s_suppkey as string) as web_agency_cd, s_name as legal_titl,
       s_acctbal as all_budget_year_dols from {supplier}
union all
select cast(8950 + s_suppkey as string), concat(s_name, ' dup'), s_acctbal * 2
from {supplier} where s_suppkey % 10 = 0
union all
select cast(100 + n_nationkey as string), n_name, n_nationkey * 1000.0e0 from {nation}""",
    "footprint_boxes": """
select p_partkey as footprint_id, p_brand as release, p_type as capture_dates_range,
       cast(p_size as double) as height,
       (p_partkey % 97) + 0.25e0 as minx, ((p_partkey * 31) % 89) + 0.25e0 as miny,
       (p_partkey % 97) + 0.75e0 + (p_partkey % 5) * 0.4e0 as maxx,
       ((p_partkey * 31) % 89) + 0.75e0 + (p_partkey % 3) * 0.7e0 as maxy
from {part}""",
    "block_boxes": """
select lpad(cast(n_regionkey as string), 3, '0') as countyfp20,
       lpad(cast(n_nationkey as string), 6, '0') as tractce20, '1000' as blockce20,
       concat('06', lpad(cast(n_nationkey as string), 13, '0')) as geoid20,
       (n_nationkey % 5) * 19.0e0 as minx, floor(n_nationkey / 5) * 19.0e0 as miny,
       (n_nationkey % 5) * 19.0e0 + 19.0e0 as maxx, floor(n_nationkey / 5) * 19.0e0 + 19.0e0 as maxy
from {nation}""",
    "place_boxes": """
select cast(r_regionkey as string) as placefp, concat('NS', cast(r_regionkey as string)) as placens,
       concat('06', cast(r_regionkey as string)) as geoid, r_name as name,
       case r_regionkey when 0 then 'M2' when 1 then 'C1' when 2 then 'U1' when 3 then 'U2' else 'H1' end as classfp,
       r_regionkey * 20.0e0 as minx, 0.0e0 as miny,
       r_regionkey * 20.0e0 + 14.0e0 as maxx, 80.0e0 as maxy
from {region}""",
    "transactions": """
select o_orderkey as id, o_custkey as user_id, cast(o_totalprice as decimal(12,2)) as amount,
       case o_orderstatus when 'F' then 'completed' when 'O' then 'pending' else 'failed' end as status
from {orders}""",
    "query_history": """
select concat(case when user_id % 3 = 0 then 'stg_' else 'mart_' end, event_type, '_',
              cast(user_id as string)) as query_text,
       'SVC_USER' as user_name, ts as start_time,
       value * 1000 as execution_time, value / 100 as credits_used_cloud_services
from {events}""",
    # Text lines of one document per region; line numbers are given, not counted.
    "entity_lines": """
select concat('doc', cast(r_regionkey as string)) as doc, cast(0 as bigint) as line_no,
       concat('  ', cast(r_regionkey * 10 as string), '  Agency of ', r_name) as line
from {region}
union all
select concat('doc', cast(n_regionkey as string)), (n_nationkey + cast(1 as bigint)) * 100000000,
       concat('       ', cast(100 + n_nationkey as string), '  Board of   ', n_name)
from {nation}
union all
select concat('doc', cast(n_regionkey as string)), (n_nationkey + cast(1 as bigint)) * 100000000 + 10 * s_suppkey + 1,
       concat('            ', cast(8950 + s_suppkey as string), '  Unit ', s_name)
from {supplier} join {nation} on s_nationkey = n_nationkey
union all
select concat('doc', cast(n_regionkey as string)), (n_nationkey + cast(1 as bigint)) * 100000000 + 10 * s_suppkey + 2,
       concat('                     and  its  offices ', cast(s_suppkey as string))
from {supplier} join {nation} on s_nationkey = n_nationkey where s_suppkey % 3 = 0
union all
select concat('doc', cast(n_regionkey as string)), (n_nationkey + cast(1 as bigint)) * 100000000 + 10 * s_suppkey + 3,
       case s_suppkey % 8 when 0 then '   17  ' else '    Uniform  Codes  Manual ' end
from {supplier} join {nation} on s_nationkey = n_nationkey where s_suppkey % 4 = 0""",
    # Documented and actual columns of one wide catalogue, a table per customer.
    "columns_documented": """
select distinct 'raw' as database, concat('S', cast(o_custkey % 3 as string)) as schema,
       concat('T', cast(o_custkey as string)) as "table", 'model' as resource_type,
       case o_orderstatus when 'P' then 'dropped' else o_orderpriority end as "column"
from {orders}""",
    "columns_actual": """
select distinct 'RAW' as database, concat('s', cast(o_custkey % 3 as string)) as schema,
       concat('t', cast(o_custkey as string)) as "table", lower(case o_orderstatus when 'O' then concat('new ', o_orderpriority)
                          else o_orderpriority end) as "column"
from {orders}""",
}

_NAME = re.compile(r"\{(\w+)\}")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A proxy as a lazy DataFrame over the files in ``sf_dir``."""
    sql = VIEWS[name].replace('"table"', "`table`").replace('"column"', "`column`")
    used = {t: table(spark, sf_dir, t) for t in set(_NAME.findall(sql))}
    return spark.sql(sql, **used)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def duck(name: str) -> str:
    """The same proxy as a subquery for DuckDB."""
    return "(" + _NAME.sub(r"\1", VIEWS[name]) + ")"
