"""Every operator as a runnable query over the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhall.functions import geometry as geo
from tallyhall.functions import text as tx
from tallyhall.functions import tiles as tl
from tallyhall.operators import clean, entities, hierarchy, quality, spatial, tables, usage
from tallyhall.plans import jobs
from tallyhall.session import materialise, scratch_path
from tallyhall.sources import readers
from tallyhall.sources.proxies import SCHEMAS, table, view
from tallyhall.streaming import usage_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EXACT = "decimal(20,8)"  # for totals that decide an order: equal in any order of addition
BATCH_FROM = dt.date(1998, 1, 1)
RELOAD = (dt.date(1996, 1, 1), dt.date(1997, 1, 1))
ASOF = "2024-01-15"
ZOOM = 9
LANDED_ZOOM = 5  # the proxy boxes span degrees, so their tiles are larger
BLOCK_RIGHT = ["countyfp20", "tractce20", "blockce20", "geoid20"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


# Shaping -------------------------------------------------------------------


def exact(df: DataFrame) -> DataFrame:
    """Double measures as decimals, so sums are the same in any order."""
    return df.withColumns({c: F.col(c).cast(EXACT) for c, t in df.dtypes if t == "double"})


def plain(df: DataFrame) -> DataFrame:
    """Decimal results as doubles again."""
    found = {c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")}
    return df.withColumns(found) if found else df


def staged(spark: SparkSession, sf: str, model: str) -> DataFrame:
    spec = usage.specs()[model]
    return usage.usage_daily(view(spark, sf, spec.source), spec)


def tidy(df: DataFrame) -> DataFrame:
    """Doubles without the last digits, which depend on the order of addition."""
    digits = {c: 6 if c.startswith("average") else 7 for c, t in df.dtypes if t == "double"}
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def boxes(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Box proxies with a WKB polygon in place of their corners."""
    corners = [F.col(c) for c in spatial.BOX]
    df = view(spark, sf, name).withColumn("geometry", geo.box_wkb(*corners))
    return df.drop(*spatial.BOX)


def centred(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Box proxies moved 45 degrees south, so that all of them lie on the globe."""
    df = view(spark, sf, name)
    return df.withColumns({c: F.col(c) - 45.0 for c in ("miny", "maxy")})


def centred_shapes(spark: SparkSession, sf: str, name: str) -> DataFrame:
    corners = [F.col(c) for c in spatial.BOX]
    df = centred(spark, sf, name).withColumn("geometry", geo.box_wkb(*corners))
    return df.drop(*spatial.BOX)


def staged_entities(spark: SparkSession, sf: str) -> DataFrame:
    return entities.stage_entities(view(spark, sf, "base_entities"))


# Usage and cost ------------------------------------------------------------


def _register_usage() -> None:
    for model in usage.specs():

        def stage(spark: SparkSession, sf: str, model: str = model) -> DataFrame:
            return tidy(staged(spark, sf, model))

        QUERIES[f"stg_{model}"] = stage
    for model in usage.COST_TYPES.values():

        def rollup(spark: SparkSession, sf: str, model: str = model) -> DataFrame:
            return tidy(usage.usage_rollup(staged(spark, sf, model)))

        QUERIES[f"int_{model}"] = rollup


_register_usage()


@query
def costs_by_date(spark: SparkSession, sf: str) -> DataFrame:
    specs = usage.specs()
    rollups = {
        kind: usage.account_credits(view(spark, sf, specs[model].source), specs[model])
        for kind, model in usage.COST_TYPES.items()
    }
    return tidy(usage.costs_long(rollups))


@query
def group_by_all(spark: SparkSession, sf: str) -> DataFrame:
    """The pipe model as SQL text with inferred grouping keys."""
    source = view(spark, sf, "pipe_usage_history")
    return tidy(
        spark.sql(
            "select organization_name, account_name, pipe_name, usage_date,"
            " sum(credits_used) as credits_used from {source} group by all",
            source=source,
        )
    )


@query
def top_queries(spark: SparkSession, sf: str) -> DataFrame:
    log = exact(view(spark, sf, "query_history"))
    top = usage.top_queries(log, ASOF, user="SVC_USER")
    return plain(top.withColumn("total_exec_time_mins", F.round("total_exec_time_mins", 6)))


@query
def slowest_queries(spark: SparkSession, sf: str) -> DataFrame:
    return usage.slowest_queries(view(spark, sf, "query_history"), "SVC_USER", like="%stg_%")


@query
def minutes_by_query(spark: SparkSession, sf: str) -> DataFrame:
    log = exact(view(spark, sf, "query_history"))
    total = usage.minutes_by_query(log, like="%stg_%")
    return plain(total.withColumn("total_exec_time_mins", F.round("total_exec_time_mins", 6)))


@query
def credits_by_warehouse(spark: SparkSession, sf: str) -> DataFrame:
    return plain(
        usage.credits_by_warehouse(exact(view(spark, sf, "warehouse_metering_history")), ASOF)
    )


# Merge, reload, deduplication ------------------------------------------------


def _clustering(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Daily totals as the stored table, its recent days doubled as the batch."""
    daily = materialise(staged(spark, sf, "automatic_clustering_history"), "clustering")
    recent = daily.filter(F.col("usage_date") >= F.lit(BATCH_FROM))
    batch = recent.withColumn("credits_used", F.col("credits_used") * 2)
    return daily, batch, usage.specs()["automatic_clustering_history"].keys


@query
def merge_keyed(spark: SparkSession, sf: str) -> DataFrame:
    target, batch, keys = _clustering(spark, sf)
    return tidy(tables.keyed_merge(target, batch, keys, null_safe=True))


@query
def merge_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The same batch twice: rows with a null key are inserted each time."""
    target, batch, keys = _clustering(spark, sf)
    once = tables.keyed_merge(target, batch, keys)
    return tidy(tables.keyed_merge(once, batch, keys))


@query
def merge_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Pipe totals stored by day; the batch brings later totals of the last days."""
    daily = staged(spark, sf, "pipe_usage_history")
    path = scratch_path(spark, "pipe-by-day")
    keys = usage.specs()["pipe_usage_history"].keys
    tables.merge_partitions(
        spark, path, daily.filter("usage_date <= date'2024-01-10'"), keys, "usage_date"
    )
    late = daily.filter("usage_date >= date'2024-01-08'")
    late = late.withColumn("files_inserted", F.col("files_inserted") + 1)
    for _ in range(2):
        tables.merge_partitions(spark, path, late, keys, "usage_date")
    return tidy(spark.read.schema(daily.schema).parquet(path))


def typed_purchases(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "purchases_landed").withColumns(
        {
            "start_date": tx.parse_us_date(F.col("start_date")),
            "end_date": tx.parse_us_date(F.col("end_date")),
            "grand_total": tx.parse_money(F.col("grand_total")),
        }
    )


@query
def range_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Reload one year from a batch that lost its services; a null date stays."""
    target = typed_purchases(spark, sf).withColumn(
        "start_date", F.when(F.col("seq") % 11 != 0, F.col("start_date"))
    )
    batch = target.filter(F.col("start_date").between(*map(F.lit, RELOAD))).filter("acquisition_type = 'IT Goods'")
    batch = batch.withColumn("description", F.lit("reloaded")).drop("lpa_contract_id")
    return tables.range_reload(target, batch, "start_date", *RELOAD)


@query
def reload_month_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The same reload on month folders, rewriting only the months it reaches."""
    rows = typed_purchases(spark, sf).select(
        "seq", "acquisition_type", "start_date", "grand_total"
    )
    rows = rows.withColumn("start_date", F.when(F.col("seq") % 11 != 0, F.col("start_date")))
    path = scratch_path(spark, "purchases-by-month")
    month = F.coalesce(F.date_format("start_date", "yyyy-MM"), F.lit("none"))
    rows.withColumn("month", month).hint("rebalance", "month").write.partitionBy("month").parquet(
        path
    )
    batch = rows.filter(F.col("start_date").between(*map(F.lit, RELOAD))).filter("acquisition_type = 'IT Goods'")
    tables.reload_month_partitions(spark, path, batch, "start_date", *RELOAD)
    schema = (
        "seq bigint, acquisition_type string, start_date date, grand_total double, month string"
    )
    return spark.read.schema(schema).parquet(path)


@query
def date_range(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of one lookback year, both ends included."""
    end = F.to_date(F.lit("1996-02-29"))
    day = F.to_date("o_orderdate")
    orders = readers.table_scan(
        spark, sf, "orders", SCHEMAS["orders"], ["o_orderkey", "o_custkey", "o_orderdate"]
    )
    return orders.filter(day.between(tx.lookback_start(end), end)).withColumn("o_orderdate", day)


def _landed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    raw = view(spark, sf, "purchases_landed").withColumnsRenamed(
        {
            "purchase_document": "Purchase Document #",
            "department": "Department",
            "department_name": "Department Name",
            "first_item_title": "First Item Title",
            "supplier_id": "Supplier ID",
            "supplier_name": "Supplier Name",
            "start_date": "Start Date",
            "end_date": "End Date",
            "grand_total": "Grand Total",
            "associated_pos": "Associated POs",
            "lpa_contract_id": "LPA Contract ID",
        }
    )
    kind = F.col("acquisition_type")
    goods = raw.filter(kind == "IT Goods").drop("acquisition_type")
    services = raw.filter(kind == "IT Services").drop("acquisition_type")
    return goods, services.drop("First Item Title")


@query
def dedup_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "purchases_landed").withColumn(
        "department", F.when(F.col("seq") % 13 != 0, F.col("department"))
    )
    return clean.dedup_keep_last(
        rows, ["purchase_document", "department"], ["acquisition_type", "seq"]
    )


@query
def clean_purchases(spark: SparkSession, sf: str) -> DataFrame:
    out = clean.clean_purchases(*_landed(spark, sf), seq="seq")
    return out.toDF(*[c.lower() for c in out.columns])


def _contracts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    landed = view(spark, sf, "contracts_landed").withColumns(
        {
            "begin_date": F.date_format("begin_date", "MM/dd/yyyy"),
            "expire_date": F.date_format("expire_date", "M/d/yyyy"),
            "buyer": F.nullif("buyer", F.lit("nan")),
        }
    )
    landed = landed.withColumnsRenamed(
        {"begin_date": "Begin  Date", "expire_date": "Expire  Date", "contract_id": "Contract ID"}
    )
    status = F.col("status")
    return landed.filter(status == "expired").drop("status"), landed.filter(status == "active").drop("status")


@query
def clean_contracts(spark: SparkSession, sf: str) -> DataFrame:
    out = clean.clean_contracts(*_contracts(spark, sf))
    return out.toDF(*[c.lower() for c in out.columns])


def _fresh_table(spark: SparkSession, database: str, name: str) -> str:
    return f"{database}.{name}_" + scratch_path(spark, "t").rsplit("-", 1)[1]


@query
def reload_purchases(spark: SparkSession, sf: str) -> DataFrame:
    """Two scrapes loaded: all of it, then one year again that lost its services."""
    goods, services = _landed(spark, sf)
    table_ = _fresh_table(spark, "procurement", "purchases")
    jobs.reload_purchases(goods, services, "seq", table_, dt.date(1900, 1, 1), dt.date(2100, 1, 1))
    year = tx.parse_us_date(F.col("Start Date")).between(*map(F.lit, RELOAD))
    again = goods.filter(year).withColumn("Supplier Name", F.upper("Supplier Name"))
    jobs.reload_purchases(again, services.filter(F.lit(False)), "seq", table_, *RELOAD)
    out = spark.table(table_).withColumn("LOADED_AT", F.col("LOADED_AT").isNotNull())
    return out.toDF(*[c.lower() for c in out.columns])


@query
def replace_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """The snapshot replaced twice; the third time one listing is empty and the table stays."""
    table_ = _fresh_table(spark, "procurement", "contracts")
    expired, active = _contracts(spark, sf)
    jobs.replace_contracts(expired, active.withColumn("buyer", F.lit("first load")), table_)
    jobs.replace_contracts(expired, active, table_)
    try:
        jobs.replace_contracts(expired, active.filter(F.lit(False)), table_)
        refused = "nothing"
    except RuntimeError as error:
        refused = str(error).split(":")[0]
    out = spark.table(table_).withColumn("LOADED_AT", F.col("LOADED_AT").isNotNull())
    return out.toDF(*[c.lower() for c in out.columns]).withColumn("refused", F.lit(refused))


def staged_purchases(spark: SparkSession, sf: str) -> DataFrame:
    return clean.stage_purchases(typed_purchases(spark, sf))


@query
def stg_purchases(spark: SparkSession, sf: str) -> DataFrame:
    return staged_purchases(spark, sf)


@query
def purchases_mart(spark: SparkSession, sf: str) -> DataFrame:
    return clean.purchases_mart(staged_purchases(spark, sf))


@query
def stg_contracts(spark: SparkSession, sf: str) -> DataFrame:
    return clean.stage_contracts(view(spark, sf, "contracts_landed"))


@query
def contracts_mart(spark: SparkSession, sf: str) -> DataFrame:
    return clean.contracts_mart(stg_contracts(spark, sf))


# Entities --------------------------------------------------------------------


@query
def stg_entities(spark: SparkSession, sf: str) -> DataFrame:
    return staged_entities(spark, sf)


@query
def stg_budgets(spark: SparkSession, sf: str) -> DataFrame:
    return entities.stage_budgets(view(spark, sf, "budgets"))


@query
def active(spark: SparkSession, sf: str) -> DataFrame:
    return entities.active(staged_entities(spark, sf))


def _moved(spark: SparkSession, sf: str) -> DataFrame:
    """Entities of which some say, or only say, that they moved."""
    base = view(spark, sf, "base_entities")
    code = F.coalesce("l1", "b", "a").cast("int")
    moved = F.when(code % 7 == 0, F.lit("Moved to")).when(
        code % 7 == 1, F.concat("name", F.lit(" renum. to 12"))
    )
    return entities.stage_entities(base.withColumn("name", F.coalesce(moved, "name")))


@query
def active_full(spark: SparkSession, sf: str) -> DataFrame:
    return entities.active(_moved(spark, sf), match="full")


@query
def active_search(spark: SparkSession, sf: str) -> DataFrame:
    return entities.active(_moved(spark, sf), match="search")


@query
def technical(spark: SparkSession, sf: str) -> DataFrame:
    return entities.technical(staged_entities(spark, sf))


@query
def agencies(spark: SparkSession, sf: str) -> DataFrame:
    return entities.agencies(entities.active(staged_entities(spark, sf)))


@query
def entity_budgets(spark: SparkSession, sf: str) -> DataFrame:
    budgets = entities.stage_budgets(view(spark, sf, "budgets"))
    return entities.entity_budgets(entities.active(staged_entities(spark, sf)), budgets)


@query
def hierarchy_(spark: SparkSession, sf: str) -> DataFrame:
    return hierarchy.parse_hierarchy(view(spark, sf, "entity_lines"))


@query
def hierarchy_files(spark: SparkSession, sf: str) -> DataFrame:
    """The same documents written as text files, one per document, and read back."""
    lines = view(spark, sf, "entity_lines")
    path = scratch_path(spark, "manuals")
    ordered = lines.repartition("doc").sortWithinPartitions("doc", "line_no")
    ordered.select("doc", "line").write.partitionBy("doc").text(path)
    parsed = hierarchy.parse_hierarchy(readers.indented_lines(spark, path))
    return parsed.select("a", "b", "l1", "l2", "l3", "name")


@query
def flatten_budgets(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.budget_tables(spark, _budget_files(spark, sf))[0]


@query
def flatten_programs(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.budget_tables(spark, _budget_files(spark, sf))[1]


def _budget_files(spark: SparkSession, sf: str) -> str:
    """Agency, department and program records as landed JSON."""
    path = scratch_path(spark, "budgets")
    raw = view(spark, sf, "budgets").withColumnsRenamed(
        {
            "web_agency_cd": "webAgencyCd",
            "legal_titl": "legalTitl",
            "all_budget_year_dols": "allBudgetYearDols",
        }
    )
    is_agency = F.length("webAgencyCd") <= 3
    raw.filter(is_agency).write.json(f"{path}/agencies")
    raw.filter(~is_agency).withColumn("displayOnWebFlg", F.lit("Y")).write.json(
        f"{path}/departments"
    )
    line = F.struct(
        F.col("p_partkey").cast("string").alias("programCode"),
        F.col("p_name").alias("programTitl"),
        F.col("p_retailprice").alias("byDols"),
    )
    part = table(spark, sf, "part")
    programs = part.groupBy((F.col("p_partkey") / 10).cast("bigint").alias("org")).agg(
        F.collect_list(line).alias("lines")  # ten lines to a department
    )
    programs.select("lines").write.json(f"{path}/programs")
    return path


# Space -------------------------------------------------------------------------


def _footprints(spark: SparkSession, sf: str) -> DataFrame:
    return boxes(spark, sf, "footprint_boxes")


def _joined(spark: SparkSession, sf: str, **options) -> DataFrame:
    """Footprints joined to shifted places, which leave gaps and overlap blocks."""
    out = spatial.spatial_join(
        _footprints(spark, sf), boxes(spark, sf, "place_boxes"),
        ["footprint_id", "height"], ["placefp", "classfp"], mode="planar", **options,
    )
    if "intersection_area" in out.columns:
        out = out.withColumn("intersection_area", F.round("intersection_area", 6))
    return out.drop("geometry")


@query
def spatial_inner(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(spark, sf, kind="inner", dedup=False)


@query
def spatial_left(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(spark, sf, kind="left", dedup=False)


@query
def spatial_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = spatial.spatial_join(
        _footprints(spark, sf), boxes(spark, sf, "block_boxes"),
        ["footprint_id"], BLOCK_RIGHT, kind="inner", mode="planar",
    )
    return out.drop("geometry")


@query
def spatial_largest(spark: SparkSession, sf: str) -> DataFrame:
    """The largest footprint under each of five boxes ten thousand million times as large."""
    corner = F.lit(-1e5) - F.col("r_regionkey")
    sides = [corner, corner, F.lit(1e5), F.lit(1e5)]
    vast = table(spark, sf, "region").select("r_regionkey", geo.box_wkb(*sides).alias("geometry"))
    footprints = _footprints(spark, sf).select("footprint_id", "geometry")
    out = spatial.spatial_join(
        vast, footprints, ["r_regionkey"], ["footprint_id"], kind="inner", mode="planar"
    )
    return out.drop("geometry")


@query
def spatial_self(spark: SparkSession, sf: str) -> DataFrame:
    """Overlaps among the footprints themselves: many matches on both sides."""
    fp = _footprints(spark, sf)
    other = fp.select(F.col("footprint_id").alias("other_id"), "geometry")
    out = spatial.spatial_join(
        fp, other, ["footprint_id"], ["other_id"], kind="inner", dedup=False, mode="planar"
    )
    # Added up as millionths, exact as decimals are: there are very many pairs.
    millionths = F.rint(F.round("intersection_area", 6) * 1e6).cast("long")
    pairs = out.groupBy("footprint_id").agg(F.count(F.lit(1)).alias("n"), F.sum(millionths).alias("shared"))
    shared = F.col("shared").cast("decimal(19,0)") * F.lit(Decimal("0.000001"))
    return plain(pairs.withColumn("shared", shared))


@query
def spatial_anti(spark: SparkSession, sf: str) -> DataFrame:
    out = spatial.spatial_anti(_footprints(spark, sf), boxes(spark, sf, "place_boxes"))
    return out.drop("geometry")


def _with_census(spark: SparkSession, sf: str, cols: list[str], mode: str) -> DataFrame:
    shapes = centred_shapes if mode == "geography" else boxes
    return spatial.footprints_with_census(
        _footprints(spark, sf) if mode == "planar" else shapes(spark, sf, "footprint_boxes"),
        shapes(spark, sf, "block_boxes"), shapes(spark, sf, "place_boxes"),
        ["footprint_id", *cols], mode,
    )


@query
def us_footprints_with_census(spark: SparkSession, sf: str) -> DataFrame:
    out = _with_census(spark, sf, ["release", "capture_dates_range"], "geography")
    return out.withColumn("area_sqm", F.round("area_sqm", -4)).drop("geometry")


@query
def global_footprints_with_census(spark: SparkSession, sf: str) -> DataFrame:
    out = _with_census(spark, sf, ["height"], "geography")
    return out.withColumn("area_sqm", F.round("area_sqm", -4)).drop("geometry")


@query
def footprint_areas(spark: SparkSession, sf: str) -> DataFrame:
    """Square metres on the sphere; a box has a closed form there."""
    out = centred_shapes(spark, sf, "footprint_boxes")
    area = geo.st_area(F.col("geometry"), "geography")
    return out.select("footprint_id", F.round(area / 1e6, 3).alias("area_sqkm"))


@query
def geometry_types(spark: SparkSession, sf: str) -> DataFrame:
    """Type code, Mercator round trip and orientation, per footprint."""
    g = F.col("geometry")
    there = geo.reproject(g, 4326, 3857)
    back = geo.reproject(there, 3857, 4326)
    fp = centred_shapes(spark, sf, "footprint_boxes")
    return fp.select(
        "footprint_id",
        geo.geom_type(g).alias("kind"),
        F.round(geo.st_area(geo.orient(back), "planar"), 6).alias("area"),
        F.round(geo.parts(there, "planar")["minx"], 3).alias("west_m"),
    )


@query
def tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Tiles covering each footprint's bounds."""
    fp = centred(spark, sf, "footprint_boxes").select("footprint_id", *spatial.BOX)
    return tl.tiles_for_bounds(fp, ZOOM).select("footprint_id", "x", "y", "quadkey")


@query
def tile_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    """Footprints whose corner tile meets a place, by exact tile pruning."""
    masks = centred_shapes(spark, sf, "place_boxes")
    wanted = spatial.tiles_touching(masks, ZOOM).select("quadkey").distinct()
    fp = centred(spark, sf, "footprint_boxes")
    x, y = tl.tile_x(F.col("minx"), ZOOM), tl.tile_y(F.col("miny"), ZOOM)
    keyed = fp.select("footprint_id", tl.quadkey(x, y, ZOOM).alias("quadkey"))
    return keyed.join(wanted, "quadkey", "left_semi")


def _tile_files(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Footprints landed as compressed GeoJSON lines, with a link catalogue.

    A tile on the border has a file of either country.
    """
    path = scratch_path(spark, "tiles")
    corners = [F.col(c) for c in spatial.BOX]
    x, y = tl.tile_x(F.col("minx"), LANDED_ZOOM), tl.tile_y(F.col("miny"), LANDED_ZOOM)
    landed = materialise(
        centred(spark, sf, "footprint_boxes").select(
            F.lit("Feature").alias("type"),
            F.struct("height", "footprint_id").alias("properties"),
            F.from_json(
                geo.box_geojson(*corners),
                "type string, coordinates array<array<array<double>>>",
            ).alias("geometry"),
            tl.quadkey(x, y, LANDED_ZOOM).alias("quadkey"),
        ),
        "features",
    )
    border = (F.substring("quadkey", -1, 1) == "3") & (F.col("properties.footprint_id") % 2 == 0)
    landed = landed.withColumn("location", F.when(border, "Canada").otherwise("UnitedStates"))
    landed.hint("rebalance", "location", "quadkey").write.partitionBy("location", "quadkey").json(
        f"{path}/features", compression="gzip"
    )
    links = landed.select(
        F.col("location").alias("Location"),
        F.col("quadkey").alias("QuadKey"),
        F.concat_ws(
            "/", F.lit(f"{path}/features"), F.concat(F.lit("location="), "location"),
            F.concat(F.lit("quadkey="), "quadkey"),
        ).alias("Url"),
        F.lit("1KB").alias("Size"),
        F.lit("2024-01-01").alias("UploadDate"),
    ).distinct()
    links.write.csv(f"{path}/links", header=True)
    return f"{path}/links", f"{path}/features"


@query
def ingest_tiles(spark: SparkSession, sf: str) -> DataFrame:
    links, features = _tile_files(spark, sf)
    masks = centred_shapes(spark, sf, "place_boxes")
    out = jobs.ingest_tiles(
        spark, links, features, masks, "UnitedStates", "height double, footprint_id bigint", LANDED_ZOOM
    )
    area = geo.st_area(F.col("geometry"), "planar")
    return out.withColumn("area", F.round(area, 6)).drop("geometry")


@query
def ingest_features(spark: SparkSession, sf: str) -> DataFrame:
    """FeatureCollections in three layouts, typed and loaded into a table."""
    path = scratch_path(spark, "collection")
    corners = [F.col(c) for c in spatial.BOX]
    feature = F.concat(
        F.lit('{"type":"Feature","properties":{"release":"'), "release", F.lit('","footprint_id":'),
        F.col("footprint_id").cast("string"), F.lit('},"geometry":'), geo.box_geojson(*corners), F.lit("}"),
    )
    # One line, a feature a line, and a feature over several lines: by runs of a thousand ids.
    run = F.floor(F.col("footprint_id") / 1000)
    layout = F.pmod(run, F.lit(3))
    spread = F.regexp_replace("feature", '"(properties|geometry)":', '\n    "$1" :\n      ')
    rows = view(spark, sf, "footprint_boxes").select(run.alias("run"), layout.alias("layout"), feature.alias("feature"))
    rows = rows.withColumn("feature", F.when(F.col("layout") == 2, spread).otherwise(F.col("feature")))
    runs = rows.groupBy("run", "layout").agg(F.collect_list("feature").alias("features"))
    joined = F.array_join("features", ", ")
    lines = F.when(F.col("layout") == 0, joined).otherwise(F.array_join("features", ",\n"))
    frame = F.concat(F.lit('{"type":"FeatureCollection","name":"x","features":['), lines, F.lit("]}"))
    runs.select(frame).write.text(path)
    table_ = _fresh_table(spark, "building_footprints", "us")
    jobs.load_features(spark, path, "release string, footprint_id bigint", table_, ["release"])
    area = geo.st_area(F.col("geometry"), "planar")
    return spark.table(table_).withColumn("area", F.round(area, 6)).drop("geometry")


@query
def load_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """The tiles of two countries, a mask's border tiles shared by both, in one table."""
    links, features = _tile_files(spark, sf)
    masks = centred_shapes(spark, sf, "place_boxes")
    table_ = _fresh_table(spark, "building_footprints", "global")
    jobs.load_tiles(
        spark, links, features, masks, ["UnitedStates", "Canada"], "height double, footprint_id bigint", table_, LANDED_ZOOM
    )
    area = geo.st_area(F.col("geometry"), "planar")
    return spark.table(table_).withColumn("area", F.round(area, 6)).drop("geometry")


def _layers(spark: SparkSession, sf: str) -> dict:
    layers = {
        "blocks": centred_shapes(spark, sf, "block_boxes"),
        "footprints": centred_shapes(spark, sf, "footprint_boxes"),
    }
    metres = {
        name: (df.select(geo.reproject(F.col("geometry"), 4326, 3857).alias("geometry")), 3857)
        for name, df in layers.items()
    }
    return {**metres, "unknown": (layers["blocks"], 2227)}


@query
def load_geo_table(spark: SparkSession, sf: str) -> DataFrame:
    """Two layers typed into one table: one replaces it, clustered by name, the other is added."""
    table_ = _fresh_table(spark, "geo_reference", "layers")
    for name, (df, epsg) in _layers(spark, sf).items():
        if name != "unknown":
            first = name == "blocks"
            named = df.withColumn("layer", F.lit(name))
            jobs.load_geo_table(named, table_, epsg, overwrite=first, cluster_by=["layer"] if first else None)
    return spark.table(table_).select("layer", F.round(geo.st_area(F.col("geometry"), "planar"), 6).alias("area"))


@query
def load_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Every layer as a table of its own; one fails and is reported."""
    loaded, failed = jobs.load_layers(_layers(spark, sf), _fresh_table(spark, "x", "tiger").split(".")[1])
    area = F.round(geo.st_area(F.col("geometry"), "planar"), 6)
    out = None
    for name in loaded:
        rows = spark.table(name).select(F.lit(name.split(".")[1]).alias("layer"), area.alias("area"))
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("failed", F.lit(",".join(sorted(failed))))


@query
def ingest_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Two census layers from Mercator metres to degrees; one fails and is reported."""
    loaded, failed = jobs.ingest_layers(_layers(spark, sf))
    out = None
    for name, df in loaded.items():
        area = F.round(geo.st_area(F.col("geometry"), "planar"), 6)
        rows = df.select(F.lit(name).alias("layer"), area.alias("area"))
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("failed", F.lit(",".join(sorted(failed))))


COUNTY = "footprint_id bigint, height double, block_geoid string, area_sqm double, county_fips string"


def _exported(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "counties")
    out = _with_census(spark, sf, ["height"], "planar")
    out = out.withColumn("area_sqm", F.round("area_sqm", 6))
    tables.export_partitions(out, path, "county_fips", geom="geometry")
    return path


@query
def export_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Export by county, then read all counties back."""
    return spark.read.schema(COUNTY).parquet(_exported(spark, sf))


@query
def read_county(spark: SparkSession, sf: str) -> DataFrame:
    """Export by county, then read one county back."""
    return tables.read_partition(spark, _exported(spark, sf), "county_fips", "003", COUNTY)


@query
def export_counties(spark: SparkSession, sf: str) -> DataFrame:
    out = _with_census(spark, sf, [], "planar")
    return tables.partition_values(out, "county_fips")


# Quality -------------------------------------------------------------------------


@query
def q_not_null(spark: SparkSession, sf: str) -> DataFrame:
    daily = staged(spark, sf, "automatic_clustering_history")
    return tidy(quality.not_null(daily, ["table_name", "credits_used"]))


@query
def q_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unique(stg_budgets(spark, sf), "primary_code")


@query
def q_unique_combination(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["organization_name", "account_name", "table_name", "usage_date"]
    return quality.unique_combination(staged(spark, sf, "automatic_clustering_history"), cols)


@query
def q_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh user is written as one that does not exist."""
    user = F.when(F.col("user_id") % 7 == 0, -F.col("user_id")).otherwise(F.col("user_id"))
    rows = view(spark, sf, "transactions").withColumn("user_id", user)
    return quality.orphans(rows, table(spark, sf, "customer"), "user_id", "c_custkey")


@query
def q_profile(spark: SparkSession, sf: str) -> DataFrame:
    out = quality.profile(view(spark, sf, "transactions"), "amount", "status")
    return out.withColumn("value", F.round("value", 2))


@query
def q_status_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return quality.status_breakdown(view(spark, sf, "transactions"), "status")


def _schema_report(spark: SparkSession, sf: str, **options) -> DataFrame:
    report = quality.validate_schemas(
        view(spark, sf, "columns_documented"), view(spark, sf, "columns_actual"), **options
    )
    lists = ["issues", "missing_columns", "undocumented_columns"]
    return report.withColumns({c: F.array_join(c, ",") for c in lists})


@query
def q_schemas(spark: SparkSession, sf: str) -> DataFrame:
    return _schema_report(spark, sf)


@query
def q_schemas_errors(spark: SparkSession, sf: str) -> DataFrame:
    return _schema_report(spark, sf, errors_only=True, undocumented_as_errors=False)


# Sinks -----------------------------------------------------------------------------


@query
def materialize_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The pipe model built twice as an incremental table: old days, then recent ones."""
    name = "pipe_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    spec = usage.specs()["pipe_usage_history"]
    daily = staged(spark, sf, "pipe_usage_history")
    early = daily.filter("usage_date <= date'2024-01-10'")
    late = daily.filter("usage_date >= date'2024-01-08'").withColumn(
        "files_inserted", F.col("files_inserted") + 1
    )
    tables.materialize(early, name, "staging", "incremental", spec.keys)
    full = tables.materialize(late, name, "staging", "incremental", spec.keys)
    return tidy(spark.table(full))


@query
def materialize_table(spark: SparkSession, sf: str) -> DataFrame:
    """A model as a table, built twice, and views on it: whole, and cut short for development."""
    name = _fresh_table(spark, "x", "supply").split(".")[1]
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    tables.materialize(rows.filter("s_nationkey < 12"), name, "marts", "table")
    full = tables.materialize(rows, name, "marts", "table", environment="prd")
    held = spark.table(full)
    whole = tables.materialize(held, f"{name}_all", "marts", "view")
    short = tables.materialize(held, f"{name}_dev", "marts", "view", limit=7)
    found = {"dev_marts": f"dev_marts.{name}", "marts": full, "whole": whole, "short": short}
    counts = [
        spark.table(t).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("s_suppkey").alias("keys")).select(F.lit(k).alias("kind"), "n", "keys")
        for k, t in found.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@query
def replace_and_append(spark: SparkSession, sf: str) -> DataFrame:
    """A clustered table replaced once, then the other rows appended."""
    name = "default.supply_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    tables.write_replace(rows, name)
    tables.write_replace(rows.filter("s_nationkey < 12"), name, cluster_by=["s_nationkey"])
    tables.write_append(rows.filter("s_nationkey >= 12"), name)
    return spark.table(name)


# Streams -----------------------------------------------------------------------------

def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    events = usage_stream.event_stream(spark, sf, "events*.parquet", SCHEMAS["events"])
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("WH_"), "event_type").alias("warehouse_name"),
        F.col("value").cast(EXACT).alias("credits_used"),
    )


@query
def stream_daily_usage(spark: SparkSession, sf: str) -> DataFrame:
    daily = usage_stream.daily_usage(
        _event_stream(spark, sf), "ts", ["warehouse_name"], "credits_used"
    )
    path = scratch_path(spark, "daily-usage")
    return plain(usage_stream.run_totals(daily, ["warehouse_name", "usage_date"], path))


@query
def stream_merge(spark: SparkSession, sf: str) -> DataFrame:
    stream = _event_stream(spark, sf).withColumn("usage_date", F.to_date("ts"))
    merged = usage_stream.merge_stream(
        stream, ["warehouse_name", "usage_date"], {"credits_used": "credits_used"},
        scratch_path(spark, "merged-usage"),
    )
    return plain(merged)
