"""The same results as one SQL statement each, for DuckDB over the driver's tables."""

from __future__ import annotations

from tallyhall.functions import fixed_values as fv
from tallyhall.operators import usage
from tallyhall.plans import queries as q
from tallyhall.sources.proxies import duck

INTEGERS = {"num_rows_reclustered", "bytes_inserted", "files_inserted"}


def _sum(c: str) -> str:
    if c in INTEGERS:
        return f"cast(sum({c}) as bigint)"
    return f"round(sum({c}), 7)"


def _exact(c: str) -> str:
    return f"cast(sum(cast({c} as {q.EXACT})) as double)"


def _avg(c: str) -> str:
    return f"round(avg({c}), 6)"


def _daily(model: str) -> str:
    spec = usage.specs()[model]
    keys = [
        f"cast({spec.derived[k]} as date) as {k}" if k in spec.derived else k for k in spec.keys
    ]
    measures = [f"{_sum(c)} as {spec.renames.get(c, c)}" for c in spec.sums]
    measures += [f"{_avg(c)} as {spec.renames.get(c, c)}" for c in spec.avgs]
    where = f" where {spec.where}" if spec.where else ""
    return (
        f"select {', '.join(keys + measures)} from {duck(spec.source)}{where} "
        f"group by {', '.join(str(i + 1) for i in range(len(keys)))}"
    )


def _rollup(model: str) -> str:
    spec = usage.specs()[model]
    day = "cast(start_time as date)" if spec.derived else "usage_date"
    credit = {new: old for old, new in spec.renames.items()}.get("credits_used", "credits_used")
    where = f" where {spec.where}" if spec.where else ""
    return (
        f"select organization_name, account_name, {day} as usage_date, "
        f"{_sum(credit)} as credits_used from {duck(spec.source)}{where} group by 1, 2, 3"
    )


def _costs() -> str:
    return " union all ".join(
        f"select account_name, usage_date, '{kind}' as usage_type, credits_used "
        f"from ({_rollup(model)})"
        for kind, model in usage.COST_TYPES.items()
    )


# Merge and reload ------------------------------------------------------------

KEYS = usage.specs()["automatic_clustering_history"].keys
BATCH = (
    f"select * replace (credits_used * 2 as credits_used) from target "
    f"where usage_date >= date '{q.BATCH_FROM}'"
)


def _match(sign: str, a: str, b: str) -> str:
    return " and ".join(f"{a}.{k} {sign} {b}.{k}" for k in KEYS)


MERGE_HEAD = f"with target as ({_daily('automatic_clustering_history')}), batch as ({BATCH})"
MERGE = (
    f"{MERGE_HEAD} select * from target where not exists (select 1 from batch where "
    f"{_match('is not distinct from', 'batch', 'target')}) union all select * from batch"
)
MERGE_TWICE = (
    f"{MERGE_HEAD}, once as (select * from target where not exists (select 1 from batch where "
    f"{_match('=', 'batch', 'target')}) union all select * from batch) "
    f"select * from once where not exists (select 1 from batch where "
    f"{_match('=', 'batch', 'once')}) union all select * from batch"
)


def _us_date(c: str) -> str:
    return f"cast(try_strptime({c}, '%m/%d/%Y') as date)"


def _money(c: str) -> str:
    return f"cast(replace(replace({c}, '$', ''), ',', '') as double)"


TYPED = f"""(select * replace ({_us_date("start_date")} as start_date, {_us_date("end_date")} as end_date,
    {_money("grand_total")} as grand_total) from {duck("purchases_landed")})"""
HOLED = f"(select * replace (case when seq % 11 <> 0 then start_date end as start_date) from {TYPED})"
SPAN = f"start_date between date '{q.RELOAD[0]}' and date '{q.RELOAD[1]}'"

RELOADED = f"""
with target as (select *, cast(null as varchar) as description from {HOLED})
select * from target where not ({SPAN}) or start_date is null
union all
select * replace (cast(null as varchar) as lpa_contract_id, 'reloaded' as description)
from target where {SPAN} and acquisition_type = 'IT Goods'"""

RELOADED_MONTHS = f"""
select seq, acquisition_type, start_date, grand_total,
       coalesce(strftime(start_date, '%Y-%m'), 'none') as month
from {HOLED} where not ({SPAN}) or start_date is null or acquisition_type = 'IT Goods'"""

DEDUP = f"""
select * exclude (rn) from (
  select *, row_number() over (partition by purchase_document, department
                               order by acquisition_type desc, seq desc) as rn
  from (select * replace (case when seq % 13 <> 0 then department end as department)
        from {duck("purchases_landed")})) where rn = 1"""

def _cleaned(where: str = "true", supplier: str = "supplier_name") -> str:
    return f"""
select purchase_document, department, department_name,
       case when acquisition_type = 'IT Goods' then first_item_title end as first_item_title,
       supplier_id, {supplier} as supplier_name, {_us_date("start_date")} as start_date,
       {_us_date("end_date")} as end_date, {_money("grand_total")} as grand_total,
       associated_pos, lpa_contract_id, acquisition_type
from (select *, row_number() over (partition by purchase_document, department
                                   order by acquisition_type desc, seq desc) as rn
      from {duck("purchases_landed")} where {where}) where rn = 1"""


CLEANED = _cleaned()
_YEAR = f"{_us_date('start_date')} between date '{q.RELOAD[0]}' and date '{q.RELOAD[1]}'"
RELOADED_TABLE = f"""
select *, true as loaded_at from (
  select * from ({CLEANED}) where not ({SPAN}) or start_date is null
  union all
  select * from ({_cleaned(f"acquisition_type = 'IT Goods' and {_YEAR}", "upper(supplier_name)")}))"""

STAGED_PURCHASES = f"""
select ltrim(purchase_document, '''') as purchase_document, department, department_name,
       first_item_title as description, ltrim(supplier_id, '''') as supplier_id, supplier_name,
       start_date, end_date, grand_total, ltrim(associated_pos, '''') as associated_pos,
       lpa_contract_id, acquisition_type from {TYPED}"""

BANDS = " ".join(
    f"when cast(department as int) >= {low}"
    + (f" and cast(department as int) < {high}" if high else "")
    + f" then '{agency}'"
    for low, high, agency in fv.AGENCY_BANDS
)
PURCHASES = f"""
select *, case when starts_with(department, '0') or length(department) < 4
               then '{fv.FIRST_BAND}' {BANDS} end as agency from ({STAGED_PURCHASES})"""

CONTRACTS = f"""
select * replace (nullif(buyer, 'nan') as buyer,
                  nullif(certification_type, 'nan') as certification_type)
from {duck("contracts_landed")}"""

# Entities ----------------------------------------------------------------------

UNITS = "|".join(fv.UNIT_PREFIX + u + fv.UNIT_SUFFIX for u in fv.UNIT_TYPES).replace("'", "''")
REORDER = rf"^({UNITS})\s*(.+)$"


def _entities(base: str) -> str:
    return f"""
(select *, case when name = 'Governor''s Office' then name
                when contains(name, 'Milton Marks') and contains(name, 'Little Hoover')
                  then 'Little Hoover Commission'
                when regexp_extract(name, '{REORDER}', 1) <> ''
                     and regexp_extract(name, '{REORDER}', 2) <> ''
                  then trim(regexp_extract(name, '{REORDER}', 2)) || ', '
                       || trim(regexp_extract(name, '{REORDER}', 1))
                else name end as name_alpha,
        case when coalesce(l3, l2, l1, subagency_code) is null then 'agency'
             when coalesce(l3, l2, l1) is null then 'subagency'
             when coalesce(l3, l2) is null then 'L1'
             when l3 is null then 'L2' else 'L3' end as ucm_level
 from (select coalesce(nullif(regexp_extract(name, '{fv.BARE_NAME}', 1), ''), name) as name,
              coalesce(l3, l2, l1, b, a) as primary_code, a as agency_code,
              case when b in (select b from {base} where contains(name, 'no subagency')
                              and contains(name, 'do not use')) then null else b end as subagency_code,
              l1, l2, l3,
              nullif(regexp_extract(name, '{fv.PARENTHETICAL}', 0), '') as parenthetical,
              contains(lower(name), 'do not use') as do_not_use,
              contains(lower(name), 'abolished') as abolished,
              nullif(regexp_extract(name, '{fv.RESTRICTED_USE}', 0), '') as restricted_use,
              name as name_raw
       from {base}))"""


STAGED = _entities(duck("base_entities"))
MOVED = _entities(
    f"""(select * replace (case when cast(coalesce(l1, b, a) as int) % 7 = 0 then 'Moved to'
         when cast(coalesce(l1, b, a) as int) % 7 = 1 then name || ' renum. to 12'
         else name end as name) from {duck("base_entities")})"""
)
IN_USE = "not do_not_use and not abolished"


def _active(staged: str, test: str) -> str:
    return (
        f"select * from {staged} where {IN_USE} and restricted_use is null "
        f"and cast(primary_code as int) < 9000 "
        f"and not {test}(lower(name_raw), '{fv.MOVED_OR_RENUMBERED}')"
    )


ACTIVE = _active(STAGED, "regexp_full_match")
BUDGETS = (
    "select web_agency_cd as primary_code, legal_titl as name, "
    f"all_budget_year_dols as budget_year_dollars from {duck('budgets')}"
)

HIERARCHY = """
select 'doc' || r_regionkey as doc, cast(0 as bigint) as line_no, cast(r_regionkey * 10 as varchar) as a,
       cast(null as varchar) as b, cast(null as varchar) as l1, cast(null as varchar) as l2,
       cast(null as varchar) as l3, 'Agency of ' || r_name as name from region
union all
select 'doc' || n_regionkey, (n_nationkey + 1::bigint) * 100000000,
       cast(n_regionkey * 10 as varchar), cast(100 + n_nationkey as varchar), null, null, null,
       'Board of ' || n_name from nation
union all
select 'doc' || n_regionkey, (n_nationkey + 1::bigint) * 100000000 + 10 * s_suppkey + 1,
       cast(n_regionkey * 10 as varchar), cast(100 + n_nationkey as varchar),
       cast(8950 + s_suppkey as varchar), null, null,
       'Unit ' || s_name || case when s_suppkey % 3 = 0 then ' and its offices ' || s_suppkey
                                 else '' end
from supplier join nation on s_nationkey = n_nationkey"""

# Space ---------------------------------------------------------------------------

FP, BLOCKS, PLACES = duck("footprint_boxes"), duck("block_boxes"), duck("place_boxes")
TOUCH = "r.minx <= l.maxx and r.maxx >= l.minx and r.miny <= l.maxy and r.maxy >= l.miny"
OVERLAP = (
    "(least(l.maxx, r.maxx) - greatest(l.minx, r.minx)) * "
    "(least(l.maxy, r.maxy) - greatest(l.miny, r.miny))"
)
OWN = "(l.maxx - l.minx) * (l.maxy - l.miny)"


def _moved(boxes: str) -> str:
    return f"(select * replace (miny - 45 as miny, maxy - 45 as maxy) from {boxes})"


SPHERE_SQM = fv.EARTH_RADIUS_M**2
SPHERE_OVERLAP = (
    f"{SPHERE_SQM!r} * radians(least(l.maxx, r.maxx) - greatest(l.minx, r.minx)) * "
    "(sin(radians(least(l.maxy, r.maxy))) - sin(radians(greatest(l.miny, r.miny))))"
)
SPHERE_OWN = (
    f"{SPHERE_SQM!r} * radians(l.maxx - l.minx) * (sin(radians(l.maxy)) - sin(radians(l.miny)))"
)


def _best(right: str, cols: list[str], left: str = FP, overlap: str = OVERLAP) -> str:
    return f"""(select * exclude (rn) from (
    select l.footprint_id, {", ".join("r." + c for c in cols)},
           row_number() over (partition by l.footprint_id order by
             {_digits(overlap)}, {", ".join("r." + c for c in cols)}) as rn
    from {left} l join {right} r on {TOUCH}) where rn = 1)"""


def _digits(area: str) -> str:
    """Order from the largest area down, to ten significant digits."""
    power = f"case when ({area}) > 0 then floor(log10({area})) else -400 end"
    return f"case when ({area}) > 0 then {power} + log10(round(({area}) / pow(10.0, {power}), 9)) else -400 end desc"


def _census(left_cols: list[str], sphere: bool = False) -> str:
    """``sphere``: boxes moved to the globe's middle, areas in square metres."""
    fp, blocks, places = (_moved(b) for b in (FP, BLOCKS, PLACES)) if sphere else (FP, BLOCKS, PLACES)
    overlap = SPHERE_OVERLAP if sphere else OVERLAP
    own = f"round({SPHERE_OWN}, -4)" if sphere else f"round({OWN}, 6)"
    classes = " ".join(f"when '{k}' then '{v}'" for k, v in fv.PLACE_CLASSES.items())
    place_cols = ["placefp", "placens", "geoid", "name", "classfp"]
    return f"""
select l.footprint_id, {"".join("l." + c + ", " for c in left_cols)}
       b.countyfp20 as county_fips, b.tractce20 as tract, b.blockce20 as block,
       b.geoid20 as block_geoid, p.placefp as place_fips, p.placens as place_ns,
       p.geoid as place_geoid, p.name as place_name, p.classfp as class_fips_code,
       case p.classfp {classes} end as class_fips, {own} as area_sqm
from {fp} l join {_best(blocks, q.BLOCK_RIGHT, fp, overlap)} b using (footprint_id)
left join {_best(places, place_cols, fp, overlap)} p using (footprint_id)"""


PAIRS = f"""
select l.footprint_id, l.height, r.placefp, r.classfp,
       case when r.placefp is not null then round({OVERLAP}, 6) end as intersection_area
from {FP} l {{kind}} join {PLACES} r on {TOUCH}"""

CENTRED = _moved(FP)


def _tile_x(lon: str, zoom: int = q.ZOOM) -> str:
    n = 1 << zoom
    p = f"(({lon}) / 360.0e0 + 0.5e0)"
    return (
        f"cast(case when {p} <= 0 then 0 when {p} >= 1 then {n - 1} "
        f"else floor(({p} + 1e-14) * {n}) end as int)"
    )


def _tile_y(lat: str, zoom: int = q.ZOOM) -> str:
    n = 1 << zoom
    s = f"sin(radians({lat}))"
    p = f"(0.5e0 - 0.25e0 * ln((1 + {s}) / (1 - {s})) / pi())"
    return (
        f"cast(case when {p} <= 0 then 0 when {p} >= 1 then {n - 1} "
        f"else floor(({p} + 1e-14) * {n}) end as int)"
    )


def _key(x: str, y: str, zoom: int = q.ZOOM) -> str:
    return " || ".join(
        f"cast((({x}) >> {b}) % 2 + 2 * ((({y}) >> {b}) % 2) as varchar)"
        for b in range(zoom - 1, -1, -1)
    )


def _tiles(boxes: str, zoom: int = q.ZOOM) -> str:
    return f"""
with ranges as (
  select footprint_id, {_tile_x("minx", zoom)} as x0, {_tile_x("maxx - 1e-11", zoom)} as x1,
         {_tile_y("maxy", zoom)} as y0, {_tile_y("miny + 1e-11", zoom)} as y1
  from {boxes}),
strips as (select *, unnest(generate_series(x0, x1)) as x from ranges),
cells as (select *, unnest(generate_series(y0, y1)) as y from strips)
select footprint_id, cast(x as int) as x, cast(y as int) as y, {_key("x", "y", zoom)} as quadkey
from cells"""


CENTRED_PLACES = (
    f"(select placefp as footprint_id, minx, miny - 45 as miny, maxx, maxy - 45 as maxy "
    f"from {PLACES})"
)


def _in_place(zoom: int) -> str:
    """Footprints whose lower-left corner lies in a tile that meets a place."""
    key = _key(_tile_x("minx", zoom), _tile_y("miny", zoom), zoom)
    return f"""(select * from (select *, {key} as quadkey from {CENTRED})
        where quadkey in (select quadkey from ({_tiles(CENTRED_PLACES, zoom)})))"""


SEMI = f"select footprint_id, quadkey from {_in_place(q.ZOOM)}"


def _ingested(location: str) -> str:
    """Tiles of a country: those on the border are shared out by the parity of ids."""
    border = "right(quadkey, 1) = '3' and footprint_id % 2 = 0"
    return f"""
select height, footprint_id, quadkey, round((maxx - minx) * (maxy - miny), 6) as area
from {_in_place(q.LANDED_ZOOM)} where {'not ' if location == 'UnitedStates' else ''}({border})"""


INGESTED = _ingested("UnitedStates")

LAYERS = f"""
select 'blocks' as layer, round((maxx - minx) * (maxy - miny), 6) as area, 'unknown' as failed
from {BLOCKS}
union all
select 'footprints', round((maxx - minx) * (maxy - miny), 6), 'unknown' from {FP}"""

LOADED_TILES = f"""
select footprint_id, height, quadkey, area, 'UnitedStates' as location from ({INGESTED})
union all
select footprint_id, height, quadkey, area, 'Canada' from ({_ingested('Canada')})"""

# Quality --------------------------------------------------------------------------

PROFILE = f"""
with t as (select * from {duck("transactions")})
select 'count' as metric, cast(count(*) as double) as value from t
union all select 'avg', round(cast(sum(amount) as double) / count(amount), 2) from t
union all select 'min', cast(min(amount) as double) from t
union all select 'max', cast(max(amount) as double) from t
union all select 'total', cast(sum(amount) as double) from t
union all select 'status ' || status, cast(count(*) as double) from t group by status"""


def _schemas(errors_only: bool, extra_fails: bool) -> str:
    extra = " or extra <> ''" if extra_fails else ""
    return f"""
with d as (select distinct upper("database") as "database", upper("schema") as "schema",
                  upper("table") as "table", resource_type, upper("column") as c
           from {duck("columns_documented")}),
a as (select distinct upper("database") as "database", upper("schema") as "schema",
             upper("table") as "table", upper("column") as c from {duck("columns_actual")}),
t as (select "database", "schema", "table", max(resource_type) as resource_type from d group by all),
r as (select t.*,
  exists (select 1 from a where a."database" = t."database" and a."schema" = t."schema"
          and a."table" = t."table") as found,
  coalesce((select string_agg(d.c, ',' order by d.c) from d where d."schema" = t."schema"
     and d."table" = t."table" and not exists (select 1 from a where a."schema" = d."schema"
     and a."table" = d."table" and a.c = d.c)), '') as missing,
  coalesce((select string_agg(a.c, ',' order by a.c) from a where a."schema" = t."schema"
     and a."table" = t."table" and not exists (select 1 from d where a."schema" = d."schema"
     and a."table" = d."table" and a.c = d.c)), '') as extra from t),
report as (select "database", "schema", "table", resource_type,
  case when not found then 'TABLE_NOT_FOUND'
       else concat_ws(',', case when missing <> '' then 'DOCUMENTED_BUT_MISSING_COLUMNS' end,
                      case when extra <> '' then 'UNDOCUMENTED_COLUMNS' end) end as issues,
  case when found then missing else '' end as missing_columns,
  case when found then extra else '' end as undocumented_columns,
  (not found or missing <> ''{extra}) as failed from r)
select * from report{" where failed" if errors_only else ""}"""


LOG, METERING = duck("query_history"), duck("warehouse_metering_history")
MINUTES = f"round(cast(sum(cast(execution_time as {q.EXACT})) as double) / 60000, 6)"
SINCE = f"start_time >= date_trunc('month', date '{q.ASOF}')"
PIPE = _daily("pipe_usage_history")
PIPE_MERGED = (
    f"with d as ({PIPE}) select * from d where usage_date < date '2024-01-08' union all "
    "select * replace (files_inserted + 1 as files_inserted) from d "
    "where usage_date >= date '2024-01-08'"
)
CLUSTERING = _daily("automatic_clustering_history")


def sql() -> dict[str, str]:
    out = {f"stg_{m}": _daily(m) for m in usage.specs()}
    out |= {f"int_{m}": _rollup(m) for m in usage.COST_TYPES.values()}
    out |= {
        "costs_by_date": _costs(),
        "group_by_all": "select organization_name, account_name, pipe_name, usage_date, "
        f"{_sum('credits_used')} as credits_used from {duck('pipe_usage_history')} group by all",
        "top_queries": f"select query_text, {MINUTES} as total_exec_time_mins, "
        f"{_exact('credits_used_cloud_services')} as total_credits_used from {LOG} "
        f"where {SINCE} and user_name = 'SVC_USER' group by 1 "
        f"order by sum(cast(execution_time as {q.EXACT})) desc, 1 limit 20",
        "slowest_queries": "select query_text, user_name, start_time, execution_time, "
        f"credits_used_cloud_services from {LOG} where user_name = 'SVC_USER' "
        "and query_text like '%stg_%' order by execution_time desc, query_text limit 20",
        "minutes_by_query": f"select query_text, {MINUTES} as total_exec_time_mins from {LOG} "
        "where query_text like '%stg_%' group by 1",
        "credits_by_warehouse": f"select warehouse_name, {_exact('credits_used')} as "
        f"total_credits_used from {METERING} where {SINCE} group by 1",
        "merge_keyed": MERGE,
        "merge_null_keys": MERGE_TWICE,
        "range_reload": RELOADED,
        "reload_month_partitions": RELOADED_MONTHS,
        "date_range": "select o_orderkey, o_custkey, cast(o_orderdate as date) as o_orderdate "
        "from orders where cast(o_orderdate as date) between date '1995-02-28' "
        "and date '1996-02-29'",
        "dedup_keep_last": DEDUP,
        "clean_purchases": CLEANED,
        "clean_contracts": f"select * replace (coalesce(buyer, 'nan') as buyer, "
        "begin_date as begin_date, expire_date as expire_date) "
        f"from {duck('contracts_landed')}",
        "stg_purchases": STAGED_PURCHASES,
        "purchases_mart": PURCHASES,
        "stg_contracts": CONTRACTS,
        "contracts_mart": CONTRACTS,
        "stg_entities": f"select * from {STAGED}",
        "stg_budgets": BUDGETS,
        "active": ACTIVE,
        "active_full": _active(MOVED, "regexp_full_match"),
        "active_search": _active(MOVED, "regexp_matches"),
        "technical": f"select * from {STAGED} where {IN_USE} and (restricted_use is not null "
        "or cast(primary_code as int) >= 9000)",
        "agencies": f"select agency_code, name from ({ACTIVE}) "
        "where subagency_code is null and l1 is null",
        "entity_budgets": "select e.primary_code, e.ucm_level, e.name, e.name_alpha, "
        f"b.name as budget_name, b.budget_year_dollars from ({ACTIVE}) e "
        f"left join ({BUDGETS}) b using (primary_code) where coalesce(e.l2, e.l3) is null",
        "hierarchy": HIERARCHY,
        "hierarchy_files": f"select a, b, l1, l2, l3, name from ({HIERARCHY})",
        "flatten_budgets": "select web_agency_cd, legal_titl, all_budget_year_dols, "
        "case when length(web_agency_cd) > 3 then 'Y' end as display_on_web_flg "
        f"from {duck('budgets')}",
        "flatten_programs": "select cast(p_partkey as varchar) as program_code, "
        "p_name as program_titl, p_retailprice as by_dols from part",
        "spatial_inner": PAIRS.format(kind="inner"),
        "spatial_left": PAIRS.format(kind="left"),
        "spatial_dedup": f"select footprint_id, {', '.join(q.BLOCK_RIGHT)} "
        f"from {_best(BLOCKS, q.BLOCK_RIGHT)}",
        "spatial_self": f"select l.footprint_id, count(*) as n, cast(sum(cast(round({OVERLAP}, 6)"
        f" as {q.EXACT})) as double) as shared from {FP} l join {FP} r on {TOUCH} group by 1",
        "spatial_anti": "select footprint_id, release, capture_dates_range, height "
        f"from {FP} l where not exists (select 1 from {PLACES} r where {TOUCH})",
        "spatial_largest": "select r_regionkey, (select footprint_id from "
        f"{FP} l order by {_digits(OWN)}, footprint_id limit 1) as footprint_id from region",
        "us_footprints_with_census": _census(["release", "capture_dates_range"], sphere=True),
        "global_footprints_with_census": _census(["height"], sphere=True),
        "footprint_areas": f"select footprint_id, round({SPHERE_SQM / 1e6!r} * radians(maxx - minx) "
        f"* (sin(radians(maxy)) - sin(radians(miny))), 3) as area_sqkm from {CENTRED}",
        "geometry_types": "select footprint_id, 3 as kind, round((maxx - minx) * (maxy - miny), 6) "
        f"as area, round(radians(minx) * {fv.MERCATOR_RADIUS_M}, 3) as west_m from {CENTRED}",
        "tiles": _tiles(CENTRED),
        "tile_semi_join": SEMI,
        "ingest_tiles": INGESTED,
        "ingest_features": "select release, footprint_id, round((maxx - minx) * (maxy - miny), 6) "
        f"as area from {FP}",
        "ingest_layers": LAYERS,
        "load_layers": LAYERS,
        "load_geo_table": f"select layer, area from ({LAYERS})",
        "load_tiles": LOADED_TILES,
        "reload_purchases": RELOADED_TABLE,
        "replace_contracts": f"select * replace (coalesce(buyer, 'nan') as buyer), true as loaded_at, "
        f"'active contracts' as refused from {duck('contracts_landed')}",
        "materialize_table": " union all ".join(
            f"select '{kind}' as kind, {n} as n, {n} as keys from supplier {where}"
            for kind, n, where in (
                ("dev_marts", "count(*)", "where s_nationkey < 12"),
                ("marts", "count(*)", ""),
                ("whole", "count(*)", ""),
                ("short", "least(count(*), 7)", ""),
            )
        ),
        "export_partitions": "select footprint_id, height, block_geoid, area_sqm, county_fips "
        f"from ({_census(['height'])})",
        "read_county": "select footprint_id, height, block_geoid, area_sqm, county_fips "
        f"from ({_census(['height'])}) where county_fips = '003'",
        "export_counties": f"select distinct county_fips from ({_census([])})",
        "q_not_null": f"select * from ({CLUSTERING}) where table_name is null "
        "or credits_used is null",
        "q_unique": f"select primary_code, count(*) as n_records from ({BUDGETS}) "
        "where primary_code is not null group by 1 having count(*) > 1",
        "q_unique_combination": "select organization_name, account_name, table_name, usage_date, "
        f"count(*) as n_records from ({CLUSTERING}) group by 1, 2, 3, 4 having count(*) > 1",
        "q_orphans": "select count(*) as orphans from (select *, case when user_id % 7 = 0 then -user_id "
        f"else user_id end as named from {duck('transactions')}) t left join customer c on t.named = c.c_custkey "
        "where c.c_custkey is null",
        "q_profile": PROFILE,
        "q_status_breakdown": f"select status, count(*) as count from {duck('transactions')} "
        "group by 1",
        "q_schemas": _schemas(False, True),
        "q_schemas_errors": _schemas(True, False),
        "materialize_incremental": PIPE_MERGED,
        "merge_partitions": PIPE_MERGED,
        "replace_and_append": "select s_suppkey, s_nationkey from supplier",
        "stream_daily_usage": "select 'WH_' || event_type as warehouse_name, "
        f"cast(ts as date) as usage_date, {_exact('value')} as credits_used from events "
        "group by 1, 2",
        "stream_merge": "select 'WH_' || event_type as warehouse_name, "
        f"cast(ts as date) as usage_date, {_exact('value')} as credits_used from events "
        "group by 1, 2",
    }
    assert set(out) <= set(q.QUERIES), set(out) - set(q.QUERIES)
    return out


