"""Registry operators exercised on the driver's tables.

Each entry builds the input shape its operator eats (JSON documents, landed
responses, CSV, zip archives, target tables) from the driver tables inside
Spark, runs the civitas operator, and returns a DataFrame. ``ORACLE`` holds
the DuckDB statement that states the expected result directly. Inputs are
always the whole tables, so the work grows with them; splits into "target"
and "batch" are by data values, never by a fixed id range.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civitas.functions import cleaning as C
from civitas.functions import json as J
from civitas.operators import audit as K
from civitas.operators import dedupe as W
from civitas.operators import ids as A
from civitas.operators import joins as JN
from civitas.operators import responses as R
from civitas.operators import upsert as U
from civitas.plans import jobs as G
from civitas.plans import views as V
from civitas.plans.summary import extract_summary
from civitas.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = " ".join(sql.split())
        return fn
    return deco


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A driver table, as it is."""
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def jstr(c: Column) -> Column:
    """JSON string literal of a text column (quotes escaped)."""
    return F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2)


# ------------------------------------------------------------------ views

@register("V6_distinct_on", """
SELECT DISTINCT ON (c_custkey) c_custkey AS code, c_name AS name, o_totalprice AS best, o_orderkey AS okey
FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus='P' AND o_orderpriority='1-URGENT') o
ON c_custkey=o_custkey ORDER BY c_custkey, o_totalprice DESC NULLS LAST, o_orderkey""")
def q_v6_distinct_on(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_name")
    o = (t(spark, d, "orders").filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))
         .select("o_custkey", "o_totalprice", "o_orderkey"))
    best = JN.best_match_left(c, o, "c_custkey", "o_custkey",
                              [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc()])
    return C.project(best, {"code": "c_custkey", "name": "c_name", "best": "o_totalprice", "okey": "o_orderkey"})


def _lgd_master(spark, d) -> DataFrame:
    c = t(spark, d, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("village_code"), F.col("c_name").alias("village_name"),
                    F.col("c_mktsegment").alias("subdistrict_name"),
                    F.col("c_nationkey").cast("string").alias("district_name"),
                    F.lit("S").alias("state_name"), F.col("c_nationkey").cast("string").alias("pincode"))


def _village_demographics(spark, d) -> DataFrame:
    o = t(spark, d, "orders")
    pop = F.when(F.col("o_orderstatus") != "F", F.floor("o_totalprice").cast("int"))
    return o.select(F.col("o_custkey").cast("string").alias("lgd_code"), pop.alias("total_population"),
                    F.col("o_orderkey").alias("households"))


@register("V6_village_discovery_view", """
SELECT DISTINCT ON (lm.village_code) lm.village_code AS lgd_code, lm.village_name AS village, lm.taluk, lm.district,
  lm.state, lm.pincode, vd.population, vd.households
FROM (SELECT CAST(c_custkey AS VARCHAR) AS village_code, c_name AS village_name, c_mktsegment AS taluk,
        CAST(c_nationkey AS VARCHAR) AS district, 'S' AS state, CAST(c_nationkey AS VARCHAR) AS pincode FROM customer) lm
LEFT JOIN (SELECT CAST(o_custkey AS VARCHAR) AS lgd_code,
        CASE WHEN o_orderstatus<>'F' THEN CAST(floor(o_totalprice) AS INTEGER) END AS population,
        o_orderkey AS households FROM orders) vd ON lm.village_code=vd.lgd_code
ORDER BY lm.village_code, vd.population DESC NULLS LAST, vd.households DESC NULLS LAST""")
def q_v6_view(spark, d):
    return V.view_village_discovery(_lgd_master(spark, d), _village_demographics(spark, d))


def _schools_from_part(spark, d) -> DataFrame:
    """School rows whose facility document is built from part columns."""
    p = t(spark, d, "part")
    flag12 = lambda cond: F.when(cond, F.lit(1)).otherwise(F.lit(2))
    data = F.struct(
        F.col("p_brand").alias("bldStatus"), F.col("p_size").alias("bldBlkTot"),
        F.col("p_type").alias("bndrywallType"),
        flag12(F.col("p_size") % 2 == 0).alias("playgroundYn"),
        flag12(F.col("p_size") % 3 == 0).alias("handrailsYn"),
        F.when(F.col("p_size") % 5 == 0, F.lit("1")).otherwise(F.lit("2")).alias("solarpanelYn"),
        flag12(F.col("p_retailprice") > 1500).alias("rainHarvestYn"),
        F.col("p_size").alias("clsrmsInst"), (F.col("p_size") % 7).alias("clsrmsGd"),
        (F.col("p_size") % 3).alias("clsrmsMin"), (F.col("p_size") % 4).alias("clsrmsMaj"),
        flag12(F.col("p_size") > 25).alias("stusHvFurnt"),
        flag12(F.col("p_partkey") % 4 == 0).alias("internetYn"), flag12(F.col("p_size") < 10).alias("ictLabYn"),
        (F.col("p_size") % 9).alias("laptopTot"), (F.col("p_size") % 6).alias("desktopFun"),
        F.lit(0).alias("projectorTot"),
        flag12(F.col("p_size") % 2 == 1).alias("hmRoomYn"), flag12(F.col("p_size") > 40).alias("libraryYn"),
        F.col("p_size").cast("string").alias("othrooms"))
    doc = F.to_json(F.struct(F.lit(True).alias("status"), data.alias("data")))
    return p.select(F.col("p_partkey").cast("string").alias("udise_code"), F.col("p_name").alias("school_name"),
                    F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).alias("state_name"),
                    F.col("p_brand").alias("district_name"), F.col("p_type").alias("block_name"),
                    F.col("p_name").alias("cluster_name"), F.col("p_size").alias("total_students"),
                    (F.col("p_size") % 2).cast("int").alias("total_boys"), F.lit(None).cast("int").alias("total_girls"),
                    F.lit(12).alias("year_id"), doc.alias("facility_data"))


_PART_BASE = "FROM part WHERE p_type<>'ECONOMY'"


@register("V1_student_population", f"""
SELECT CAST(p_partkey AS VARCHAR) AS udise_code, p_name AS school_name, p_type AS state, p_brand AS district,
  p_type AS block, p_name AS cluster, p_size AS total_students, CAST(p_size%2 AS INTEGER) AS total_boys,
  CAST(NULL AS INTEGER) AS total_girls, 12 AS year_id {_PART_BASE}""")
def q_v1(spark, d):
    return V.view_student_population(_schools_from_part(spark, d))


@register("V2_campus_assets", f"""
SELECT CAST(p_partkey AS VARCHAR) AS udise_code, p_name AS school_name, p_type AS state_name,
  p_brand AS building_status, p_size AS building_blocks, p_type AS boundary_wall_type,
  (p_size%2=0) AS has_playground, CAST(NULL AS BOOLEAN) AS has_ramps, (p_size%3=0) AS has_handrails,
  (p_size%5=0) AS has_solar_power, (p_retailprice>1500) AS has_rain_harvesting {_PART_BASE}""")
def q_v2(spark, d):
    return V.view_campus_assets(_schools_from_part(spark, d))


@register("V3_classroom_condition", f"""
SELECT CAST(p_partkey AS VARCHAR) AS udise_code, p_name AS school_name, p_size AS total_classrooms,
  CAST(p_size%7 AS INTEGER) AS rooms_good, CAST(p_size%3 AS INTEGER) AS rooms_minor_repair,
  CAST(p_size%4 AS INTEGER) AS rooms_major_repair, CAST(NULL AS INTEGER) AS rooms_pucca_good,
  (p_size>25) AS has_furniture {_PART_BASE}""")
def q_v3(spark, d):
    return V.view_classroom_condition(_schools_from_part(spark, d))


@register("V4_digital_infrastructure", f"""
SELECT CAST(p_partkey AS VARCHAR) AS udise_code, p_name AS school_name, (p_partkey%4=0) AS has_internet,
  (p_size<10) AS has_ict_lab, CAST(p_size%9 AS INTEGER) AS laptop_count, CAST(p_size%6 AS INTEGER) AS desktop_count,
  0 AS projector_count, CAST(NULL AS INTEGER) AS printer_count {_PART_BASE}""")
def q_v4(spark, d):
    return V.view_digital_infrastructure(_schools_from_part(spark, d))


@register("V5_specialized_spaces", f"""
SELECT CAST(p_partkey AS VARCHAR) AS udise_code, p_name AS school_name, (p_size%2=1) AS has_principal_room,
  (p_size>40) AS has_library, CAST(NULL AS BOOLEAN) AS has_atal_tinkering_lab,
  p_size AS staff_and_store_rooms_count {_PART_BASE}""")
def q_v5(spark, d):
    return V.view_specialized_spaces(_schools_from_part(spark, d))


def _amenities_raw(spark, d) -> DataFrame:
    c, n, r = t(spark, d, "customer"), t(spark, d, "nation"), t(spark, d, "region")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    return j.select(
        F.col("r_name").alias("state"),
        F.when(F.col("n_regionkey") != 0, F.col("n_name")).alias("district"),
        F.col("c_mktsegment").alias("sub_district"), F.col("c_name").alias("ulb_rlb_village"),
        F.col("c_acctbal").cast("string").alias("total_geographical_area_covered_by_village"),
        F.col("c_custkey").cast("string").alias("number_of_village_households"),
        F.col("n_name").alias("name_of_the_nearest_statutory_town"),
        F.col("c_nationkey").cast("string").alias("distance_between_village_and_nearest_statutory_town"),
        F.col("r_name").alias("name_of_the_district_head_quarter_of_village"),
        F.col("n_regionkey").cast("string").alias("distance_between_the_village_and_district_head_quarter"),
        F.col("c_mktsegment").alias("name_of_the_subdistrict_head_quarter_of_village"),
        F.lit("").alias("distance_between_village_and_sub_district_head_quarter"),
        F.lit("unused").alias("some_other_raw_column"))


_AMENITIES_SQL = """
SELECT r_name AS state, CASE WHEN n_regionkey<>0 THEN n_name END AS district, c_mktsegment AS sub_district,
  c_name AS village,
  CASE WHEN n_regionkey<>0 THEN r_name||'-'||n_name||'-'||c_mktsegment||'-'||c_name END AS composite_key,
  CAST(c_acctbal AS VARCHAR) AS area_ha, CAST(c_custkey AS VARCHAR) AS households, n_name AS nearest_town_name,
  CAST(c_nationkey AS VARCHAR) AS distance_to_nearest_town_km, r_name AS district_hq_name,
  CAST(n_regionkey AS VARCHAR) AS distance_to_district_hq_km, c_mktsegment AS taluk_hq_name,
  '' AS distance_to_taluk_hq_km
FROM customer JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey"""


@register("V7_village_amenities", _AMENITIES_SQL)
def q_v7(spark, d):
    return V.view_village_amenities(_amenities_raw(spark, d))


@register("G3_amenities_load", _AMENITIES_SQL)
def q_g3(spark, d):
    raw = _amenities_raw(spark, d)
    base = scratch_path(spark, "g3")
    csv_path = f"{base}/landing"
    from civitas.sources.csv import write_csv
    write_csv(raw, csv_path)
    return G.amenities_load(spark, csv_path, raw.columns, f"{base}/raw")


# -------------------------------------------------------- dedupe / queues

_TOUCHED = "o_orderpriority='1-URGENT' AND o_orderstatus='O'"


@register("W2_keep_latest", f"""
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate DESC, o_orderkey DESC) rn FROM orders) x
WHERE rn<=5 OR o_custkey NOT IN (SELECT o_custkey FROM orders WHERE {_TOUCHED})""")
def q_w2(spark, d):
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    touched = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")
    kept = W.keep_latest(o, "o_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 5, touched)
    return kept.select("o_custkey", "o_orderkey")


@register("W3_fold_batch", """
SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS first_status, arg_max(o_totalprice, o_orderkey) AS last_price
FROM orders GROUP BY 1""")
def q_w3(spark, d):
    o = t(spark, d, "orders")
    f = W.fold_batch(o, "o_custkey", "o_orderkey", last_cols=["o_totalprice"], first_cols=["o_orderstatus"])
    return f.select("o_custkey", F.col("o_orderstatus").alias("first_status"),
                    F.col("o_totalprice").alias("last_price"))


def _queue_table(spark, d) -> DataFrame:
    o = t(spark, d, "orders")
    status = (F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "pending")
              .otherwise("partial"))
    return o.select("o_orderkey", F.col("o_orderpriority").alias("state_name"), status.alias("scrape_status"),
                    F.lpad(F.col("o_orderkey").cast("string"), 11, "0").alias("udise_code"),
                    F.when(F.col("o_orderkey") % 2 == 0, F.lit(12)).alias("effective_year"))


_QUEUE_SQL = """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'pending'
  ELSE 'partial' END AS scrape_status, lpad(CAST(o_orderkey AS VARCHAR), 11, '0') AS udise_code,
  CASE WHEN o_orderkey%2=0 THEN 12 END AS effective_year FROM orders WHERE o_orderpriority='5-LOW'"""


@register("W4_work_queue", f"""
SELECT o_orderkey, scrape_status FROM ({_QUEUE_SQL}) q WHERE scrape_status IN ('pending','partial')
ORDER BY scrape_status DESC, udise_code LIMIT 100""")
def q_w4(spark, d):
    return W.work_queue(_queue_table(spark, d), "5-LOW", "normal", 100).select("o_orderkey", "scrape_status")


@register("W5_recovery_queue", f"""
SELECT o_orderkey, scrape_status FROM ({_QUEUE_SQL}) q
WHERE scrape_status IN ('pending','partial','success') AND effective_year IS NULL
ORDER BY scrape_status, udise_code LIMIT 100""")
def q_w5(spark, d):
    return W.work_queue(_queue_table(spark, d), "5-LOW", "recovery", 100).select("o_orderkey", "scrape_status")


@register("W5_recovery_queue_unlimited", f"""
SELECT o_orderkey, scrape_status FROM ({_QUEUE_SQL}) q
WHERE scrape_status IN ('pending','partial','success') AND effective_year IS NULL""")
def q_w5_all(spark, d):
    return W.work_queue(_queue_table(spark, d), "5-LOW", "recovery", 0).select("o_orderkey", "scrape_status")


@register("W4_work_queue_unlimited", f"""
SELECT o_orderkey, scrape_status FROM ({_QUEUE_SQL}) q WHERE scrape_status IN ('pending','partial')""")
def q_w4_all(spark, d):
    return W.work_queue(_queue_table(spark, d), "5-LOW", "normal", 0).select("o_orderkey", "scrape_status")


@register("W6_priority_queue", """
SELECT c_custkey, CAST(list_position(['BUILDING','MACHINERY','HOUSEHOLD'], c_mktsegment) AS INTEGER) AS priority
FROM customer WHERE list_position(['BUILDING','MACHINERY','HOUSEHOLD'], c_mktsegment)>0
ORDER BY priority, c_custkey""")
def q_w6(spark, d):
    q = W.priority_queue(t(spark, d, "customer"), ["BUILDING", "MACHINERY", "HOUSEHOLD"], "c_mktsegment",
                         then=[F.col("c_custkey").asc()])
    return q.select("c_custkey", "priority")


# -------------------------------------------------------------- scalars

@register("P1_P3_where_present", """
SELECT c_custkey AS code, c_name AS school_name, c_mktsegment AS state FROM customer
WHERE NULLIF(c_mktsegment,'BUILDING') IS NOT NULL""")
def q_p3(spark, d):
    c = t(spark, d, "customer").withColumn("c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    return C.project(C.where_present(c, "c_mktsegment"),
                     {"code": "c_custkey", "school_name": "c_name", "state": "c_mktsegment"})


@register("P2_composite_key", """
SELECT c_custkey, (c_mktsegment || '-' || CASE WHEN c_nationkey<>5 THEN c_name END || '-' ||
  CAST(c_nationkey AS VARCHAR)) AS k FROM customer""")
def q_p2(spark, d):
    c = t(spark, d, "customer")
    name = F.when(F.col("c_nationkey") != 5, F.col("c_name"))
    return c.select("c_custkey", C.composite_key("c_mktsegment", name, "c_nationkey").alias("k"))


@register("P4_json_text", "SELECT event_id, props::json->>'k' AS k FROM events")
def q_p4(spark, d):
    return t(spark, d, "events").select("event_id", J.json_text("props", "$.k").alias("k"))


@register("P5_P6_json_int_flag", """
SELECT event_id, CAST(props::json->>'k' AS INTEGER) AS k, (CAST(props::json->>'k' AS INTEGER)=1) AS is_one,
  (CAST(props::json->>'absent' AS INTEGER)=1) AS missing FROM events""")
def q_p5(spark, d):
    e = t(spark, d, "events")
    return e.select("event_id", J.json_int("props", "$.k").alias("k"), J.json_flag("props", "$.k").alias("is_one"),
                    J.json_flag("props", "$.absent").alias("missing"))


@register("P7_strict_flag", """
SELECT event_id, (event_id%2=0 AND CAST(props::json->>'k' AS INTEGER)=1) AS f FROM events""")
def q_p7(spark, d):
    e = t(spark, d, "events")
    k = J.json_int("props", "$.k")
    doc = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(k.alias("k")))) \
           .otherwise(F.to_json(F.struct(k.cast("string").alias("k"))))
    return e.select("event_id", J.strict_flag(J.variant(doc), "$.k").alias("f"))


@register("P8_na", """
SELECT c_custkey, CAST(CASE WHEN c_nationkey=3 THEN -1 ELSE c_nationkey END AS INTEGER) AS n FROM customer""")
def q_p8(spark, d):
    c = t(spark, d, "customer")
    return c.select("c_custkey", C.na(F.when(F.col("c_nationkey") != 3, F.col("c_nationkey"))).alias("n"))


@register("P9_total_or_parts", """
SELECT c_custkey, CAST(CASE WHEN c_nationkey%3=0 THEN (CASE WHEN c_nationkey%2=0 THEN -1 ELSE c_nationkey END)
  ELSE 99 END AS INTEGER) AS total FROM customer""")
def q_p9(spark, d):
    c = t(spark, d, "customer")
    total = F.when(F.col("c_nationkey") % 3 != 0, F.lit(99))
    a = F.when(F.col("c_nationkey") % 2 == 1, F.col("c_nationkey"))
    b = F.lit(None).cast("int")
    return c.select("c_custkey", C.total_or_parts(C.na(total), C.na(a), C.na(b)).cast("int").alias("total"))


@register("P10_clean_int", """
SELECT c_custkey, CAST(CASE WHEN c_nationkey IN (0,4,8,12,16) THEN 0 WHEN c_nationkey IN (20,24) THEN 1000
  WHEN c_nationkey=2 THEN 9223372036854775807 ELSE CAST(trunc(c_acctbal) AS BIGINT) END AS BIGINT) AS n FROM customer""")
def q_p10(spark, d):
    c = t(spark, d, "customer")
    text = (F.when(F.col("c_nationkey") == 0, "n/a").when(F.col("c_nationkey") == 4, "1d")
            .when(F.col("c_nationkey") == 8, "nan").when(F.col("c_nationkey") == 12, "")
            .when(F.col("c_nationkey") == 16, "Infinity").when(F.col("c_nationkey") == 20, "1_000")
            .when(F.col("c_nationkey") == 2, "1e30").when(F.col("c_nationkey") == 24, " 1e3 ").otherwise(F.col("c_acctbal").cast("string")))
    return c.select("c_custkey", C.clean_int(text).alias("n"))


@register("P11_row_sum", """
SELECT p_partkey, CAST(p_size AS BIGINT)+CAST(trunc(p_retailprice) AS BIGINT) AS total FROM part""")
def q_p11(spark, d):
    p = t(spark, d, "part")
    return p.select("p_partkey", C.row_sum(C.clean_int(F.col("p_size").cast("string")),
                                           C.clean_int(F.col("p_retailprice").cast("string"))).alias("total"))


@register("P12_unmask_code", """
SELECT c_custkey, CASE WHEN c_custkey%7=0 THEN NULL WHEN c_custkey%5=0 THEN 'PLAIN'||CAST(c_custkey AS VARCHAR)
  ELSE CAST(c_nationkey AS VARCHAR) || right(lpad(CAST(c_custkey AS VARCHAR),9,'0'),5) END AS code FROM customer""")
def q_p12(spark, d):
    c = t(spark, d, "customer")
    raw = F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("PLAIN"), F.col("c_custkey").cast("string"))) \
           .otherwise(F.concat(F.lit("2912****"), F.right(F.lpad(F.col("c_custkey").cast("string"), 9, "0"),
                                                          F.lit(5))))
    block = F.when(F.col("c_custkey") % 7 != 0, F.col("c_nationkey").cast("string"))
    return c.select("c_custkey", C.unmask_code(raw, block).alias("code"))


@register("P13_initial_status", """
SELECT c_custkey, CASE WHEN c_custkey%4 IN (0,1) THEN 'pending' ELSE 'closed_registry' END AS st,
  CASE c_custkey%4 WHEN 0 THEN 'Unknown' WHEN 3 THEN NULL ELSE c_name END AS nm,
  CASE c_custkey%4 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 1 END AS status FROM customer""")
def q_p13(spark, d):
    c = t(spark, d, "customer")
    m = F.col("c_custkey") % 4
    name = jstr(F.col("c_name"))
    doc = (F.when(m == 0, F.lit("{}"))
           .when(m == 1, F.concat(F.lit('{"schoolStatus": 0, "schoolStatusName": '), name, F.lit("}")))
           .when(m == 2, F.concat(F.lit('{"schoolStatus": 1, "schoolStatusName": '), name, F.lit("}")))
           .otherwise(F.lit('{"schoolStatus": null, "schoolStatusName": null}')))
    s = J.initial_status(J.variant(doc))
    return c.select("c_custkey", s["scrape_status"].alias("st"), s["status_name"].alias("nm"),
                    s["school_status"].alias("status"))


@register("P14_truthy_text", """
SELECT c_custkey, CASE c_custkey%4 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN CAST(c_custkey+1 AS VARCHAR) || '.0'
  ELSE CAST(c_custkey+1 AS VARCHAR) END AS t FROM customer""")
def q_p14(spark, d):
    c = t(spark, d, "customer")
    m = F.col("c_custkey") % 4
    doc = (F.when(m == 0, F.lit('{"pincode": 0}')).when(m == 1, F.lit('{"pincode": "0"}'))
           .when(m == 2, F.concat(F.lit('{"pincode": '), (F.col("c_custkey") + 1).cast("string"), F.lit(".0}")))
           .otherwise(F.concat(F.lit('{"pincode": '), (F.col("c_custkey") + 1).cast("string"), F.lit("}"))))
    return c.select("c_custkey", J.truthy_text(J.variant(doc), "$.pincode").alias("t"))


@register("P15_slug", "SELECT p_partkey, lower(replace(p_name,' ','_')) AS slug FROM part")
def q_p15(spark, d):
    return t(spark, d, "part").select("p_partkey", C.slug("p_name").alias("slug"))


@register("P16_classify_response", """
SELECT o_orderkey, CASE o_orderkey%4 WHEN 0 THEN 'retry' WHEN 1 THEN 'ok' ELSE 'bad' END AS c FROM orders""")
def q_p16(spark, d):
    o = t(spark, d, "orders")
    m = F.col("o_orderkey") % 4
    status = F.when(m == 0, 503).when(m == 3, 404).otherwise(200)
    body = (F.when(m == 1, F.lit('{"status": true, "data": {}}')).when(m == 2, F.lit('{"status": "true"}'))
            .otherwise(F.lit("not json")))
    return o.select("o_orderkey", J.classify_response(status, body).alias("c"))


@register("P17_completeness", """
SELECT o_orderkey, CASE WHEN o_orderstatus='F' AND o_orderpriority='1-URGENT' THEN 'success' ELSE 'partial' END AS st
FROM orders""")
def q_p17(spark, d):
    o = t(spark, d, "orders")
    a = F.when(F.col("o_orderstatus") == "F", 200).when(F.col("o_orderstatus") == "O", 404)
    b = F.when(F.col("o_orderpriority") == "1-URGENT", 200).otherwise(503)
    return o.select("o_orderkey", C.completeness(a, b).alias("st"))


@register("P18_with_defaults", """
SELECT s_suppkey, s_name, 'PENDING' AS status, false AS active, TIMESTAMP '2024-01-01 00:00:00' AS loaded_at,
  s_nationkey FROM supplier""")
def q_p18(spark, d):
    s = t(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return C.with_defaults(s, {"status": "PENDING", "active": False, "s_nationkey": -1,
                               "loaded_at": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")})


@register("P20_json_or", """
SELECT s_suppkey, CASE s_suppkey%3 WHEN 0 THEN 12 WHEN 2 THEN 11 END AS y FROM supplier""")
def q_p20(spark, d):
    s = t(spark, d, "supplier")
    m = F.col("s_suppkey") % 3
    doc = (F.when(m == 0, F.lit('{"data": {}}')).when(m == 1, F.lit('{"data": {"yearId": null}}'))
           .otherwise(F.lit('{"data": {"yearId": 11}}')))
    return s.select("s_suppkey", J.json_or(J.variant(doc), "$.data.yearId", 12).alias("y"))


@register("P21_profile_fields", """
SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS body_id, c_name AS body_name,
  CASE WHEN c_nationkey%2=0 THEN c_mktsegment END AS ward FROM customer""")
def q_p21(spark, d):
    c = t(spark, d, "customer")
    data = F.struct(F.col("c_nationkey").alias("lgdurbanlocalbodyId"), F.col("c_name").alias("lgdurbanlocalbodyName"),
                    F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")).alias("lgdwardName"))
    doc = F.to_json(F.struct(data.alias("data")))
    pf = J.profile_fields(doc, {"body_id": "lgdurbanlocalbodyId", "body_name": "lgdurbanlocalbodyName",
                                "ward": "lgdwardName"})
    return c.select("c_custkey", pf["body_id"].alias("body_id"), pf["body_name"].alias("body_name"),
                    pf["ward"].alias("ward"))


@register("P22_lookup_code", """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 129 WHEN 'MACHINERY' THEN 130 END AS code,
  CASE WHEN c_mktsegment NOT IN ('BUILDING','MACHINERY') THEN 'unknown_name' ELSE '' END AS reasons FROM customer""")
def q_p22(spark, d):
    c = t(spark, d, "customer")
    code = C.lookup_code(F.initcap("c_mktsegment"), {"Building": 129, "machinery": 130})
    good, bad = U.split_rejects(c.select("c_custkey", code.alias("code")), {"unknown_name": F.col("code").isNull()})
    return good.withColumn("reasons", F.lit("")).unionByName(bad)


# ---------------------------------------------------------------- joins

@register("J1_enrich_left", """
SELECT c_custkey, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey<>0) n
ON c_nationkey=n_nationkey""")
def q_j1(spark, d):
    n = t(spark, d, "nation").filter(F.col("n_regionkey") != 0).select("n_nationkey", "n_name")
    return JN.enrich_left(t(spark, d, "customer"), n, "c_nationkey", "n_nationkey").select("c_custkey", "n_name")


@register("J2_expand_hierarchy", """
SELECT r_name, n_name, c_custkey, o_orderkey FROM region JOIN nation ON n_regionkey=r_regionkey
JOIN customer ON c_nationkey=n_nationkey JOIN orders ON o_custkey=c_custkey""")
def q_j2(spark, d):
    levels = [
        (t(spark, d, "region").select("r_regionkey", "r_name"), None, "r_regionkey"),
        (t(spark, d, "nation").select("n_regionkey", "n_nationkey", "n_name"), "n_regionkey", "n_nationkey"),
        (t(spark, d, "customer").select("c_nationkey", "c_custkey"), "c_nationkey", "c_custkey"),
        (t(spark, d, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey"),
    ]
    return JN.expand_hierarchy(levels).select("r_name", "n_name", "c_custkey", "o_orderkey")


@register("J3_orphans", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN
(SELECT o_orderkey FROM orders WHERE o_orderstatus<>'P')""")
def q_j3(spark, d):
    parent = t(spark, d, "orders").filter(F.col("o_orderstatus") != "P")
    return JN.orphans(t(spark, d, "lineitem"), parent, "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber")


@register("K4_audit_reference", """
SELECT l_orderkey, l_linenumber, 'reference' AS rule FROM lineitem WHERE l_orderkey NOT IN
(SELECT o_orderkey FROM orders WHERE o_orderstatus<>'P')""")
def q_k4(spark, d):
    parent = t(spark, d, "orders").filter(F.col("o_orderstatus") != "P")
    return K.audit_reference(t(spark, d, "lineitem"), parent, "l_orderkey", "o_orderkey") \
            .select("l_orderkey", "l_linenumber", "rule")


@register("J4_cascade_delete", """
SELECT l_orderkey, count(*)::BIGINT AS n FROM lineitem WHERE l_orderkey NOT IN
(SELECT o_orderkey FROM orders JOIN customer ON c_custkey=o_custkey WHERE c_nationkey=0) GROUP BY 1""")
def q_j4(spark, d):
    doomed = t(spark, d, "customer").filter(F.col("c_nationkey") == 0).select("c_custkey")
    _, lines = JN.cascade_delete(doomed, "c_custkey", [
        (t(spark, d, "orders"), "o_custkey", "o_orderkey"),
        (t(spark, d, "lineitem"), "l_orderkey", None)])
    return lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@register("J4_cascade_tree", """
WITH c AS (SELECT c_custkey FROM customer WHERE c_nationkey<>0),
o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)),
s AS (SELECT s_suppkey FROM supplier WHERE s_nationkey<>0),
l AS (SELECT 1 FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o) AND l_suppkey IN (SELECT s_suppkey FROM s))
SELECT 'nation' AS tab, count(*)::BIGINT AS n FROM nation WHERE n_nationkey<>0 UNION ALL SELECT 'customer', count(*)::BIGINT FROM c
UNION ALL SELECT 'orders', count(*)::BIGINT FROM o UNION ALL SELECT 'supplier', count(*)::BIGINT FROM s
UNION ALL SELECT 'lineitem', count(*)::BIGINT FROM l""")
def q_j4_tree(spark, d):
    """One parent with two children (customer, supplier) and one child with two parents (lineitem)."""
    tables = {n: t(spark, d, n) for n in ("nation", "customer", "supplier", "orders", "lineitem")}
    links = [("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"),
             ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
             ("lineitem", "l_suppkey", "supplier", "s_suppkey")]
    doomed = tables["nation"].filter("n_nationkey = 0").select("n_nationkey")
    kept = JN.cascade_tree(tables, links, "nation", doomed, "n_nationkey")
    out = None
    for name, df in kept.items():
        n = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tab"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@register("J5_effective_year", """
SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN (CASE WHEN o_orderpriority='1-URGENT' THEN 10 ELSE 12 END)
  WHEN 'O' THEN 11 ELSE 12 END AS INTEGER) AS y, (o_orderstatus='P') AS missing FROM orders""")
def q_j5(spark, d):
    o = t(spark, d, "orders")
    schools = o.select(F.col("o_orderkey").alias("school_id"))
    primary = o.select(F.col("o_orderkey").alias("school_id"),
                       F.when(F.col("o_orderstatus") == "F", 200).otherwise(404).alias("code"),
                       F.when(F.col("o_orderpriority") == "1-URGENT", 10).alias("year"))
    probe = o.select(F.col("o_orderkey").alias("school_id"),
                     F.when(F.col("o_orderstatus") != "P", 200).otherwise(503).alias("code"))
    r = JN.resolve_effective_year(schools, primary, probe)
    return r.select(F.col("school_id").alias("o_orderkey"), F.col("effective_year").alias("y"),
                    F.col("missing_on_server").alias("missing"))


@register("J6_lookup", "SELECT c_custkey, c_name FROM customer WHERE c_name='Customer#000000007'")
def q_j6(spark, d):
    return JN.lookup(t(spark, d, "customer"), "c_name", "Customer#000000007").select("c_custkey", "c_name")


# ----------------------------------------------------------- aggregates

@register("A1_resume_offset", "SELECT CAST(floor(count(*)/1000)*1000 AS BIGINT) AS \"offset\" FROM lineitem")
def q_a1(spark, d):
    return A.resume_offset(None, t(spark, d, "lineitem"), "lgd_master")


@register("A1_resume_offset_persisted", """
SELECT CAST(coalesce((SELECT max(s_suppkey) FROM supplier WHERE s_name='Supplier#000000007'),
  floor((SELECT count(*) FROM lineitem)/1000)*1000) AS BIGINT) AS "offset" """)
def q_a1p(spark, d):
    status = t(spark, d, "supplier").select(F.col("s_name").alias("job_name"),
                                            F.col("s_suppkey").alias("last_offset"))
    return A.resume_offset(status, t(spark, d, "lineitem"), "Supplier#000000007")


@register("A2_assign_ids", """
SELECT s_suppkey, CAST((SELECT max(c_custkey) FROM customer)+row_number() OVER (ORDER BY s_suppkey) AS BIGINT) AS id
FROM supplier""")
def q_a2(spark, d):
    s = t(spark, d, "supplier").select("s_suppkey")
    return A.assign_ids(s, t(spark, d, "customer").select(F.col("c_custkey").alias("id")), "id", ["s_suppkey"])


@register("A3_assemble_fragments", """
SELECT user_id, arg_max(value, event_id) FILTER (WHERE event_type='click') AS click,
  arg_max(value, event_id) FILTER (WHERE event_type='view') AS view_ FROM events GROUP BY 1""")
def q_a3(spark, d):
    e = t(spark, d, "events")
    return R.assemble_fragments(e, "user_id", ["click", "view"], name_col="event_type", doc_col="value",
                                seq_col="event_id", columns={"view": "view_"})


@register("A4_build_manifest", """
SELECT user_id, '{' || string_agg('"' || event_type || '":200', ',' ORDER BY event_type) || '}' AS manifest
FROM (SELECT DISTINCT user_id, event_type FROM events) x GROUP BY 1""")
def q_a4(spark, d):
    e = t(spark, d, "events").select("user_id", "event_type", F.lit(200).alias("code"))
    return R.build_manifest(e, "user_id", name_col="event_type")


@register("A4_build_manifest_named", """
SELECT user_id, '{' || string_agg('"' || event_type || '":200', ',' ORDER BY event_type) || '}' AS manifest
FROM (SELECT DISTINCT user_id, event_type FROM events) x GROUP BY 1""")
def q_a4_named(spark, d):
    e = t(spark, d, "events").select("user_id", "event_type", F.lit(200).alias("code"))
    return R.build_manifest(e, "user_id", name_col="event_type",
                            names=["click", "error", "purchase", "signup", "view"])


def _attempts(spark, d) -> DataFrame:
    e = t(spark, d, "events")
    status = F.when(F.col("event_type") == "error", 503).when(F.col("event_type").isin("purchase", "click"), 200) \
              .otherwise(404)
    body = (F.when(F.col("event_type") == "purchase", F.lit('{"status": true, "data": {"v": 1}}'))
            .when((F.col("event_type") == "click") & (F.col("event_id") % 2 == 0), F.lit("not json"))
            .when(F.col("event_type") == "click", F.lit('{"status": "true"}')))
    return e.select((F.col("event_id") / 3).cast("bigint").alias("req"),
                    ((F.col("event_id") % 3) + 1).cast("int").alias("attempt"),
                    status.alias("http_status"), body.alias("body"))


@register("A5_resolve_attempts", """
SELECT event_id//3 AS req, CAST(coalesce(arg_min(CASE WHEN event_type='error' THEN 503 ELSE 200 END, event_id)
  FILTER (WHERE event_type IN ('error','purchase')), 404) AS INTEGER) AS code
FROM events WHERE event_id%3<2 GROUP BY 1""")
def q_a5(spark, d):
    return R.resolve_attempts(_attempts(spark, d), "req", max_attempts=2).select("req", "code")


@register("A5_resolve_attempts_http200", """
SELECT event_id//3 AS req, CAST(CASE WHEN bool_or(event_type='purchase' OR (event_type='click' AND event_id%2=1)) THEN 200 ELSE 404 END
  AS INTEGER) AS code FROM events GROUP BY 1""")
def q_a5b(spark, d):
    return R.resolve_attempts(_attempts(spark, d), "req", max_attempts=3, outcome="http200").select("req", "code")


@register("A6_with_metrics", """
SELECT count(*) AS "rows", CAST(count_if(o_orderstatus='P') AS BIGINT) AS rejected FROM orders""")
def q_a6(spark, d):
    o = t(spark, d, "orders").withColumn("__bad", F.col("o_orderstatus") == "P")
    observed, obs = R.with_metrics(o, "orders_load", "__bad")
    observed.write.format("noop").mode("overwrite").save()
    m = obs.get
    return spark.createDataFrame([(int(m["rows"]), int(m["rejected"]))], "rows long, rejected long")


@register("A6_committed_counters", """
WITH o AS (SELECT o_custkey AS k, o_orderkey % 3 AS run, o_orderstatus='P' AS bad FROM orders),
s AS (SELECT count(*) AS n, count(DISTINCT k) AS keys FROM (SELECT l_suppkey AS k FROM lineitem))
SELECT 'orders' AS job_name, CAST(3 AS BIGINT) AS runs, count(*) AS rows_read, CAST(count_if(bad) AS BIGINT) AS rows_rejected,
  count(DISTINCT k) FILTER (WHERE NOT bad) AS rows_added FROM o
UNION ALL SELECT 'suppliers', 1, n, 0, keys FROM s
UNION ALL SELECT 'rows', NULL, NULL, NULL, (SELECT count(DISTINCT k) FROM o WHERE NOT bad) + keys FROM s""")
def q_a6_committed(spark, d):
    """Three runs of one job and one of another into a table, each run twice: replays leave rows and counters as they are."""
    from civitas.sources.tables import commit_run, read_counters, read_latest
    base = scratch_path(spark, "a6")
    schema = spark.createDataFrame([], "kind string, k long, v double").schema
    o = t(spark, d, "orders").select(F.lit("o").alias("kind"), F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"),
                                     (F.col("o_orderstatus") == "P").alias("bad"), F.col("o_orderkey").alias("seq"))
    parts = [("orders", f"orders-{i}", o.filter(F.col("seq") % 3 == i)) for i in range(3)]
    li = t(spark, d, "lineitem").select(F.lit("s").alias("kind"), F.col("l_suppkey").alias("k"), F.col("l_extendedprice").alias("v"),
                                        F.lit(False).alias("bad"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"))
    for job, run, rows in [*parts, ("suppliers", "suppliers-0", li)]:
        for _ in range(2):
            merged = U.upsert(read_latest(spark, base, schema), rows.filter(~F.col("bad")).drop("bad"), ["kind", "k"], {"v": U.OVERWRITE}, seq="seq")
            commit_run(merged, base, run, job, read=rows, rejects=rows.filter("bad"))
    total = read_latest(spark, base).agg(F.count(F.lit(1)).alias("rows_added")).withColumn("job_name", F.lit("rows"))
    return read_counters(spark, base).unionByName(total, allowMissingColumns=True)


# -------------------------------------------------------------- upserts

def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


_T1 = "2024-01-01 00:00:00"
_T2 = "2024-02-01 00:00:00"


def _cust_target_batch(spark, d):
    c = t(spark, d, "customer")
    target = c.filter(F.col("c_nationkey") < 13).select(
        "c_custkey", F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"),
        _ts(_T1).alias("created_at"))
    batch = c.filter(F.col("c_nationkey") >= 7).select(
        "c_custkey", (-F.col("c_acctbal")).alias("bal"), F.lit("NEW").alias("seg"))
    return target, batch


@register("U1_upsert", """
SELECT c_custkey, CASE WHEN c_nationkey>=7 THEN -c_acctbal ELSE c_acctbal END AS bal,
  CASE WHEN c_nationkey>=7 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS created_at
FROM customer""")
def q_u1(spark, d):
    target, batch = _cust_target_batch(spark, d)
    out = U.upsert(target, batch, "c_custkey", {"bal": U.OVERWRITE, "created_at": U.stamp(_ts(_T2))})
    return out.select("c_custkey", "bal", "created_at")


@register("U2_upsert_keep", """
SELECT c_custkey, CASE WHEN c_nationkey<13 THEN c_mktsegment ELSE 'NEW' END AS seg,
  CASE WHEN c_nationkey>=7 THEN -c_acctbal ELSE c_acctbal END AS bal FROM customer""")
def q_u2(spark, d):
    target, batch = _cust_target_batch(spark, d)
    out = U.upsert(target, batch, "c_custkey", {"bal": U.OVERWRITE, "seg": U.KEEP})
    return out.select("c_custkey", "seg", "bal")


@register("U3_upsert_sticky", """
SELECT o_orderkey, CASE WHEN o_orderstatus='F' AND o_orderpriority<>'5-LOW' THEN 'success' ELSE 'pending' END AS st,
  CAST(CASE WHEN o_orderstatus='O' AND o_orderpriority<>'5-LOW' THEN 11 ELSE 12 END AS INTEGER) AS eff FROM orders""")
def q_u3(spark, d):
    o = t(spark, d, "orders")
    status = (F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "partial")
              .otherwise("closed_registry"))
    target = o.filter(F.col("o_orderpriority") != "5-LOW").select(
        "o_orderkey", status.alias("st"), F.when(F.col("o_orderstatus") == "O", F.lit(11)).alias("eff"))
    batch = o.select("o_orderkey", F.lit("pending").alias("st"), F.lit(12).alias("eff"))
    out = U.upsert(target, batch, "o_orderkey", {"st": U.sticky("success"), "eff": U.FILL})
    return out.select("o_orderkey", "st", "eff")


@register("U2_fold_and_upsert", """
WITH b AS (SELECT o_custkey AS k, arg_min(o_orderstatus, o_orderkey) AS fs, arg_max(o_totalprice, o_orderkey) AS lp
           FROM orders GROUP BY 1),
     tg AS (SELECT c_custkey AS k FROM customer WHERE c_nationkey<13)
SELECT coalesce(tg.k, b.k) AS c_custkey, CASE WHEN tg.k IS NOT NULL THEN 'T' ELSE b.fs END AS st,
  CASE WHEN b.k IS NOT NULL THEN b.lp ELSE -1.0 END AS price
FROM tg FULL OUTER JOIN b ON tg.k=b.k""")
def q_u2_fold(spark, d):
    c = t(spark, d, "customer")
    target = c.filter(F.col("c_nationkey") < 13).select("c_custkey", F.lit("T").alias("st"),
                                                        F.lit(-1.0).alias("price"))
    batch = t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("st"),
                                         F.col("o_totalprice").alias("price"), "o_orderkey")
    return U.upsert(target, batch, "c_custkey", {"price": U.OVERWRITE, "st": U.KEEP}, seq="o_orderkey")


@register("U4_insert_absent", """
SELECT c_custkey, CASE WHEN c_nationkey<13 THEN c_name ELSE 'seed-a' END AS name FROM customer""")
def q_u4(spark, d):
    c = t(spark, d, "customer")
    target = c.filter(F.col("c_nationkey") < 13).select("c_custkey", F.col("c_name").alias("name"))
    batch = c.select("c_custkey", F.lit("seed-b").alias("name"), F.lit(2).alias("seq")).unionByName(
        c.select("c_custkey", F.lit("seed-a").alias("name"), F.lit(1).alias("seq")))
    return U.insert_absent(target, batch, ["c_custkey"], seq="seq")


@register("U4_insert_absent_two_keys", """
WITH tg AS (SELECT 'a' || c_custkey AS userid, 'm' || c_custkey AS email, 0 AS seq FROM customer WHERE c_nationkey<13),
b AS (SELECT CASE WHEN o_orderstatus='P' THEN NULL ELSE 'a' || o_custkey END AS userid,
        CASE WHEN o_orderpriority='5-LOW' THEN NULL ELSE 'm' || o_orderkey END AS email, o_orderkey AS seq FROM orders),
f AS (SELECT b.* FROM b WHERE (userid IS NULL OR userid NOT IN (SELECT userid FROM tg))
        AND (email IS NULL OR email NOT IN (SELECT email FROM tg)))
SELECT userid, email FROM tg UNION ALL
SELECT userid, email FROM f WHERE userid IS NULL OR seq = (SELECT min(seq) FROM f g WHERE g.userid = f.userid)""")
def q_u4_two(spark, d):
    """Two nullable unique keys: emails repeat between target and batch only, user ids inside the batch too."""
    c, o = t(spark, d, "customer"), t(spark, d, "orders")
    tag = lambda p, col: F.concat(F.lit(p), F.col(col).cast("string"))
    target = c.filter(F.col("c_nationkey") < 13).select(tag("a", "c_custkey").alias("userid"), tag("m", "c_custkey").alias("email"))
    batch = o.select(F.when(F.col("o_orderstatus") != "P", tag("a", "o_custkey")).alias("userid"),
                     F.when(F.col("o_orderpriority") != "5-LOW", tag("m", "o_orderkey")).alias("email"),
                     F.col("o_orderkey").alias("seq"))
    return U.insert_absent(target, batch, ["userid", "email"], seq="seq")


@register("U5_update_from", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus='F')
  THEN 0.0 ELSE l_tax END AS tax FROM lineitem""")
def q_u5(spark, d):
    target = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_tax").alias("tax"))
    changes = t(spark, d, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("l_orderkey"), F.lit(0.0).alias("tax"))
    return U.update_from(target, changes, "l_orderkey", ["tax"])


@register("U6_touch", """
SELECT c_custkey, CASE WHEN c_mktsegment='BUILDING' THEN -c_acctbal ELSE c_acctbal END AS bal,
  CASE WHEN c_mktsegment='BUILDING' THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END
  AS updated_at FROM customer""")
def q_u6(spark, d):
    c = t(spark, d, "customer")
    target = c.select("c_custkey", F.col("c_acctbal").alias("bal"), _ts(_T1).alias("updated_at"))
    changes = c.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", (-F.col("c_acctbal")).alias("bal"))
    return U.update_from(target, changes, "c_custkey", ["bal"], touch_col="updated_at", as_of=_ts(_T2))


@register("U7_update_where", """
SELECT p_partkey, CASE WHEN p_brand='Brand#2' THEN 'moved' ELSE p_brand END AS p_brand,
  CASE WHEN p_brand='Brand#2' THEN p_size+1 ELSE p_size END AS p_size FROM part""")
def q_u7(spark, d):
    p = t(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    return U.update_where(p, F.col("p_brand") == "Brand#2", {"p_brand": F.lit("moved"), "p_size": F.col("p_size") + 1})


@register("U8_split_rejects", """
SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus NOT IN ('F','O') THEN 'status' END,
  CASE WHEN length(o_orderpriority)>8 THEN 'length' END) AS reasons FROM orders""")
def q_u8(spark, d):
    o = t(spark, d, "orders")
    good, bad = U.split_rejects(o, {"status": ~F.col("o_orderstatus").isin("F", "O"),
                                    "length": ~K.fits("o_orderpriority", "varchar(8)")})
    return good.select("o_orderkey", F.lit("").alias("reasons")).unionByName(bad.select("o_orderkey", "reasons"))


# ---------------------------------------------------------------- audits

@register("K1_audit_not_null", """
SELECT c_custkey, 'c_mktsegment' AS "column", 'not_null' AS rule FROM customer WHERE c_mktsegment='HOUSEHOLD'""")
def q_k1(spark, d):
    c = t(spark, d, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("HOUSEHOLD")))
    return K.audit_not_null(c, ["c_name", "c_mktsegment"]).select("c_custkey", "column", "rule")


@register("K2_audit_unique", """
SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem GROUP BY 1,2 HAVING count(*)>1""")
def q_k2(spark, d):
    return K.audit_unique(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]).drop("rule")


@register("K3_audit_partial_unique", """
SELECT o_custkey, count(*)::BIGINT AS n FROM orders WHERE o_orderstatus='P' GROUP BY 1 HAVING count(*)>1""")
def q_k3(spark, d):
    return K.audit_unique(t(spark, d, "orders"), "o_custkey", where=F.col("o_orderstatus") == "P").drop("rule")


@register("K5_audit_in", """
SELECT o_orderkey FROM orders WHERE o_orderstatus NOT IN ('F','O')""")
def q_k5(spark, d):
    return K.audit_in(t(spark, d, "orders"), "o_orderstatus", ["F", "O"]).select("o_orderkey")


@register("K6_audit_fits", "SELECT p_partkey FROM part WHERE length(p_name)>10")
def q_k6(spark, d):
    return K.audit_fits(t(spark, d, "part"), "p_name", "varchar(10)").select("p_partkey")


@register("K6_audit_fits_numeric", """
SELECT c_custkey FROM customer WHERE c_acctbal/1000 >= 9.995 OR c_acctbal/1000 <= -9.995""")
def q_k6n(spark, d):
    c = t(spark, d, "customer").withColumn("ratio", F.col("c_acctbal") / 1000)
    return K.audit_fits(c, "ratio", "numeric(3,2)").select("c_custkey")


@register("K_audit_report", """
SELECT 'status' AS rule, count(*)::BIGINT AS n FROM orders WHERE o_orderstatus NOT IN ('F','O')
UNION ALL SELECT 'dup_line', count(*)::BIGINT FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber
  HAVING count(*)>1) x""")
def q_kreport(spark, d):
    rep = K.audit([(K.audit_in(t(spark, d, "orders"), "o_orderstatus", ["F", "O"]), "status"),
                   (K.audit_unique(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]), "dup_line")])
    return rep.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@register("K_audit_tables", """
SELECT 'not_null:orders.o_custkey' AS rule, count(*)::BIGINT AS n FROM orders WHERE o_orderstatus='P'
UNION ALL SELECT 'unique:lineitem.l_orderkey+l_linenumber', count(*)::BIGINT FROM
  (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*)>1) x
UNION ALL SELECT 'unique:orders.o_custkey', count(*)::BIGINT FROM (SELECT 1 FROM orders WHERE o_orderstatus='F' GROUP BY o_custkey HAVING count(*)>1) x
UNION ALL SELECT 'reference:orders.o_custkey', count(*)::BIGINT FROM orders JOIN customer ON c_custkey=o_custkey
  WHERE o_orderstatus<>'P' AND c_nationkey=0
UNION ALL SELECT 'reference:lineitem.l_orderkey', count(*)::BIGINT FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'allowed:orders.o_orderstatus', count(*)::BIGINT FROM orders WHERE o_orderstatus='P'
UNION ALL SELECT 'type:customer.c_name', count(*)::BIGINT FROM customer WHERE length(c_name)>17 AND c_nationkey<>0""")
def q_kset(spark, d):
    """A declared rule set over four tables, with NULLs, orphans and repeated keys in them."""
    tables = {"customer": t(spark, d, "customer").filter("c_nationkey <> 0"), "lineitem": t(spark, d, "lineitem"),
              "orders": t(spark, d, "orders").withColumn("o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))}
    rules = K.RuleSet(
        not_null=(("orders", ("o_custkey",)), ("absent_table", ("x",))),
        unique=(("lineitem", ("l_orderkey", "l_linenumber"), None), ("orders", ("o_custkey",), "o_orderstatus = 'F'")),
        references=(("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey")),
        allowed=(("orders", "o_orderstatus", ("F", "O")),), types=(("customer", "c_name", "varchar(17)"),))
    report = K.audit_tables(tables, rules).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    names = spark.createDataFrame([(f"{k}",) for k in (
        "not_null:orders.o_custkey", "unique:lineitem.l_orderkey+l_linenumber", "unique:orders.o_custkey", "reference:orders.o_custkey",
        "reference:lineitem.l_orderkey", "allowed:orders.o_orderstatus", "type:customer.c_name")], "rule string")
    return names.join(report, "rule", "left").select("rule", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


# ------------------------------------------------------- sources / sinks

@register("S1_csv_positional", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id%50=0 THEN NULL WHEN doc_id%50=1 THEN '' ELSE text END AS text,
  CAST(length(CASE WHEN doc_id%50=0 THEN NULL WHEN doc_id%50=1 THEN '' ELSE text END) AS BIGINT) AS n FROM documents""")
def q_s1(spark, d):
    from civitas.sources.csv import read_csv_positional, write_csv
    docs = t(spark, d, "documents")
    text = F.when(F.col("doc_id") % 50 == 0, F.lit(None).cast("string")) \
            .when(F.col("doc_id") % 50 == 1, F.lit("")).otherwise(F.col("text"))
    path = scratch_path(spark, "s1")
    # header names differ from the target columns on purpose: mapping is by position
    write_csv(docs.select(F.col("doc_id").alias("id_header"), text.alias("body_header")), path)
    back = read_csv_positional(spark, path, ["doc_id", "text"])
    return back.select("doc_id", "text", F.length("text").cast("bigint").alias("n"))


@register("S2_zip_member_csv", """
SELECT CAST(l_orderkey AS VARCHAR) AS state_name, CAST(l_linenumber AS VARCHAR) AS district_name,
  CAST(trunc(l_quantity) AS BIGINT) AS sc, CAST(trunc(l_extendedprice) AS BIGINT) AS st, CAST(0 AS BIGINT) AS gen
FROM lineitem""")
def q_s2(spark, d):
    from civitas.sources.zipped import read_zip_member_csv
    li = t(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("srcStateName"),
        F.col("l_linenumber").cast("string").alias("srcDistrictName"),
        F.col("l_quantity").cast("string").alias("Number of SC population"),
        F.col("l_extendedprice").cast("string").alias("Number of ST population"))
    path = _land_archives(li, F.floor(F.col("srcStateName").cast("bigint") / 1000))
    rows = read_zip_member_csv(spark, path, "9307_source_data.csv", dict(G.DISTRICT_HEADERS), glob="*")
    return rows.select(F.col("srcStateName").alias("state_name"), F.col("srcDistrictName").alias("district_name"),
                       C.clean_int(F.col("`Number of SC population`")).alias("sc"),
                       C.clean_int(F.col("`Number of ST population`")).alias("st"),
                       C.clean_int(F.col("`Number of general population`")).alias("gen"))


def _land_archives(rows: DataFrame, number: Column, order: tuple[str, ...] = ()) -> str:
    """A folder of zip archives, one per ``number`` (a bounded run of keys): a CSV member beside a decoy."""
    shown = [c for c in rows.columns if c not in order]

    @F.pandas_udf("binary")
    def zipped(texts):
        import io
        import zipfile

        def pack(text):
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
                z.writestr("readme.txt", "decoy member")
                z.writestr("data/NDAP_9307_source_data.csv", text)
            return buf.getvalue()
        return texts.map(pack)

    line = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in shown])
    lines = rows.groupBy(number.alias("archive")).agg(F.sort_array(F.collect_list(F.struct(*order, line.alias("line")))).alias("lines"))
    text = F.concat_ws("\n", F.lit(",".join(shown)), F.col("lines.line"))
    path = scratch_path(rows.sparkSession, "archives")
    # the text writer writes the bytes as they are: one archive per file, in folders that sort like their numbers
    named = lines.select(F.lpad(F.col("archive").cast("string"), 15, "0").alias("archive"), zipped(text).cast("string").alias("value"))
    named.write.option("maxRecordsPerFile", 1).partitionBy("archive").text(path)
    return path


@register("S3_csv_named", """
SELECT s_suppkey, s_name, CASE WHEN s_suppkey%2=0 THEN 'extra' END AS s_sometimes, CAST(NULL AS VARCHAR) AS s_missing FROM supplier""")
def q_s3(spark, d):
    from civitas.sources.csv import read_csv_named, write_csv
    s = t(spark, d, "supplier")
    path = scratch_path(spark, "s3")
    # files of one folder whose headers differ in order and in columns
    write_csv(s.filter("s_suppkey % 2 = 1").select("s_acctbal", "s_name", "s_suppkey"), f"{path}/a")
    write_csv(s.filter("s_suppkey % 2 = 0").select("s_suppkey", F.lit("extra").alias("s_sometimes"), "s_name"), f"{path}/b")
    return read_csv_named(spark, f"{path}/*", {"s_suppkey": "bigint", "s_name": "string", "s_sometimes": "string",
                                               "s_missing": "string"})


def _records_pages(spark, d, nested: bool) -> DataFrame:
    o = t(spark, d, "orders")
    rec = F.struct(F.col("o_orderkey").alias("villageCode"), F.col("o_orderpriority").alias("villageNameEnglish"))
    # pages of at most 100 records: a page never grows with the data
    pages = o.groupBy((F.col("o_orderkey") / 100).cast("bigint").alias("page")).agg(F.collect_list(rec).alias("r"))
    env = F.struct(F.struct(F.col("r").alias("content")).alias("data")) if nested else F.struct(F.col("r").alias("records"))
    return pages.select("page", F.to_json(env).alias("body"))


def _faulty(pages: DataFrame, first_key: str) -> DataFrame:
    """Landed pages with faults: of five, one repeats its first key (the last value counts), one is cut off, one has text
    behind its end, and one holds an object where the array should be."""
    kind = F.col("page") % 5
    doubled = F.concat(F.lit('{"' + first_key + '": [], '), F.expr("substr(body, 2)"))
    no_array = F.replace(F.replace("body", F.lit("[{"), F.lit('{"0": {')), F.lit("}]"), F.lit("}}"))
    no_array = F.replace(no_array, F.lit("},{"), F.lit('}, "1": {'))
    return pages.withColumn("body", F.when(kind == 1, doubled).when(kind == 2, F.expr("substr(body, 1, length(body) - 3)"))
                            .when(kind == 3, no_array).when(kind == 4, F.concat("body", F.lit("] x"))).otherwise(F.col("body")))


def _with_bad_pages(good: DataFrame, bad: DataFrame) -> DataFrame:
    rejected = bad.select(F.lit(None).cast(dict(good.dtypes)["code"]).alias("code"), F.col("page").cast("string").alias("name"), "reasons")
    return good.withColumn("reasons", F.lit("")).unionByName(rejected)


_BAD_PAGES = """SELECT DISTINCT o_orderkey//100 AS page, CASE WHEN (o_orderkey//100)%5=3 THEN 'records_not_array' ELSE 'invalid_body' END AS why
  FROM orders WHERE (o_orderkey//100)%5>=2"""


@register("S4_explode_records", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS code, o_orderpriority AS name, '' AS reasons FROM orders WHERE (o_orderkey//100)%5<2
UNION ALL SELECT NULL, CAST(page AS VARCHAR), why FROM ({_BAD_PAGES}) x""")
def q_s4(spark, d):
    from civitas.sources.envelope import parse_bodies, parsed_records, rejected_bodies
    parsed = G.stored(parse_bodies(_faulty(_records_pages(spark, d, nested=False), "records"), "body", "$.records"), "s4")
    good = parsed_records(parsed, {"code": "villageCode", "name": "villageNameEnglish"})
    return _with_bad_pages(good.select("code", "name"), rejected_bodies(parsed))


@register("S5_explode_nested", f"""
SELECT o_orderkey AS code, o_orderpriority AS name, '' AS reasons FROM orders WHERE (o_orderkey//100)%5<2
UNION ALL SELECT NULL, CAST(page AS VARCHAR), why FROM ({_BAD_PAGES}) x""")
def q_s5(spark, d):
    from civitas.sources.envelope import parse_bodies, parsed_records, rejected_bodies
    parsed = G.stored(parse_bodies(_faulty(_records_pages(spark, d, nested=True), "data"), "body", "$.data.content"), "s5")
    good = parsed_records(parsed, {"code": ("villageCode", "bigint"), "name": "villageNameEnglish"})
    return _with_bad_pages(good.select("code", "name"), rejected_bodies(parsed))


@register("S6_append_table", "SELECT c_custkey, CAST(2 AS BIGINT) AS n FROM customer")
def q_s6(spark, d):
    from civitas.sources.tables import append_table
    path = scratch_path(spark, "s6")
    c = t(spark, d, "customer").select("c_custkey", "c_name")
    append_table(c, path)
    append_table(c, path)
    return spark.read.parquet(path).groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n"))


@register("S8_rotate_table", "SELECT s_suppkey, s_name FROM supplier")
def q_s8(spark, d):
    from civitas.sources.tables import read_latest, rotate_table, write_version
    base = scratch_path(spark, "s8")
    write_version(t(spark, d, "supplier").select("s_suppkey", "s_name"), f"{base}/table")
    from pyspark.sql import types as T
    fresh = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("flag", T.StringType())])
    rotate_table(spark, f"{base}/table", f"{base}/backup", fresh)
    assert read_latest(spark, f"{base}/table").columns == ["s_suppkey", "flag"]
    return read_latest(spark, f"{base}/backup")


@register("S9_ensure_column", """
SELECT c_custkey, c_name, '{}' AS downstream_summary FROM customer""")
def q_s9(spark, d):
    from civitas.sources.tables import ensure_column
    c = t(spark, d, "customer").select("c_custkey", "c_name")
    c = ensure_column(c, "downstream_summary", "string", "{}")
    return ensure_column(c, "c_name", "string", "ignored")


@register("S7_incremental_equals_batch", """
SELECT coalesce(k, c_custkey) AS o_custkey, coalesce(price, -c_acctbal) AS price
FROM (SELECT o_custkey AS k, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY 1) x
FULL OUTER JOIN (SELECT * FROM customer WHERE c_nationkey<13) c ON c_custkey=k""")
def q_s7(spark, d):
    """Three streams with a fresh checkpoint each, one after the other, into a table that already holds data."""
    from civitas.sources.tables import read_latest, write_version
    from civitas.streaming.incremental import incremental_upsert
    base = scratch_path(spark, "s7")
    c = t(spark, d, "customer").filter("c_nationkey < 13")
    write_version(c.select(F.col("c_custkey").alias("o_custkey"), F.lit(0.0).alias("price")), f"{base}/target")
    write_version(c.select(F.col("c_custkey").alias("o_custkey"), (-F.col("c_acctbal")).alias("price")), f"{base}/target")
    o = t(spark, d, "orders").select("o_custkey", "o_totalprice", "o_orderkey")
    # Landed in key order (cut at approximate terciles, two scalars): the
    # stream's "later wins" then equals the batch's "largest order key wins".
    q1, q2 = o.approxQuantile("o_orderkey", [1 / 3, 2 / 3], 0.01)
    cuts = [F.col("o_orderkey") < q1, (F.col("o_orderkey") >= q1) & (F.col("o_orderkey") < q2),
            F.col("o_orderkey") >= q2]
    for i, cond in enumerate(cuts):
        o.filter(cond).write.mode("overwrite").json(f"{base}/landing/part-{i}")
        incremental_upsert(
            spark, f"{base}/landing/part-{i}", "o_custkey long, o_totalprice double, o_orderkey long",
            f"{base}/target", "o_custkey long, price double", f"{base}/checkpoint-{i}", "o_custkey",
            {"price": U.OVERWRITE}, seq="o_orderkey",
            prepare=lambda b: b.select("o_custkey", F.col("o_totalprice").alias("price"), "o_orderkey"),
            status_path=f"{base}/status", job="orders", max_files_per_trigger=8)
    return read_latest(spark, f"{base}/target")


# ------------------------------------------------------------------ jobs

@register("G1_geography_sync", f"""
WITH r AS (SELECT CAST(o_custkey AS VARCHAR) AS code, * FROM orders WHERE (o_orderkey//100)%5<2 AND (o_orderkey//100)%25<>0),
f AS (SELECT code, (arg_max([o_orderpriority], o_orderkey))[1] AS name, (arg_min([o_orderstatus], o_orderkey))[1] AS district,
    (arg_max([CASE WHEN o_orderkey%7=0 THEN NULL ELSE CAST(o_orderkey%7 AS VARCHAR) END], o_orderkey))[1] AS pincode
  FROM r GROUP BY code),
tg AS (SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS code, c_name AS name, 'T' AS district, '000' AS pincode
  FROM customer WHERE c_nationkey<13),
nw AS (SELECT code, (SELECT max(id) FROM tg) + row_number() OVER (ORDER BY code) AS id FROM f
  WHERE code NOT IN (SELECT code FROM tg))
SELECT coalesce(tg.code, f.code) AS village_code, coalesce(f.name, tg.name) AS village_name,
  CASE WHEN tg.code IS NOT NULL THEN tg.district ELSE f.district END AS district_code,
  CASE WHEN f.code IS NOT NULL THEN f.pincode ELSE tg.pincode END AS pincode,
  CAST(coalesce(tg.id, nw.id) AS INTEGER) AS id, (f.code IS NOT NULL) AS restamped, '' AS reasons
FROM tg FULL OUTER JOIN f ON tg.code=f.code LEFT JOIN nw ON nw.code=f.code
UNION ALL SELECT NULL, CAST(page AS VARCHAR), NULL, NULL, NULL, NULL, why FROM ({_BAD_PAGES}) x
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'page_null' FROM (SELECT DISTINCT o_orderkey//100 AS page FROM orders) x WHERE page%25=0""")
def q_g1(spark, d):
    o = t(spark, d, "orders")
    pin = F.when(F.col("o_orderkey") % 7 == 0, F.lit(0)).otherwise((F.col("o_orderkey") % 7).cast("int"))
    rec = F.struct(F.col("o_orderkey").alias("k"),
                   F.struct(F.col("o_custkey").cast("string").alias("villageCode"),
                            F.col("o_orderpriority").alias("villageNameEnglish"),
                            F.col("o_orderstatus").alias("districtCode"),
                            pin.alias("pincode")).alias("r"))
    pages = (o.groupBy((F.col("o_orderkey") / 100).cast("bigint").alias("page"))
             .agg(F.array_sort(F.collect_list(rec)).alias("rs"))
             .select("page", F.to_json(F.struct(F.col("rs.r").alias("records"))).alias("body")))
    target = conform(spark, t(spark, d, "customer").filter("c_nationkey < 13").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").cast("string").alias("village_code"),
        F.col("c_name").alias("village_name"), F.lit("T").alias("district_code"), F.lit("000").alias("pincode"),
        _ts(_T1).alias("last_updated")), G.LGD_MASTER_DDL)
    # every twenty-fifth page lost its number
    pages = _faulty(pages, "records").withColumn("page", F.when(F.col("page") % 25 != 0, F.col("page")))
    table, rejects = G.geography_sync(target, pages, as_of=_ts(_T2))
    loaded = table.select("village_code", "village_name", "district_code", "pincode", F.col("id").cast("int").alias("id"),
                          (F.col("last_updated") == _ts(_T2)).alias("restamped"), F.lit("").alias("reasons"))
    none = lambda kind, n: F.lit(None).cast(kind).alias(n)
    return loaded.unionByName(rejects.select(
        "village_code", F.col("page").cast("string").alias("village_name"), none("string", "district_code"),
        none("string", "pincode"), none("int", "id"), none("boolean", "restamped"), "reasons"))


@register("G1_geography_increment", """
WITH p AS (SELECT count(*)//100 AS n FROM orders), lim AS (SELECT (n//3)*100 AS gap, ((2*n)//3)*100 + 37 AS done FROM p),
f AS (SELECT CAST(o_custkey AS VARCHAR) AS code, arg_max(o_orderpriority, o_orderkey) AS name, arg_min(o_orderstatus, o_orderkey) AS district
  FROM orders, lim WHERE o_orderkey < done GROUP BY 1)
SELECT code, name, district, CAST(NULL AS BIGINT) AS last_offset FROM f
UNION ALL SELECT 'run 1', 'waiting', NULL, gap FROM lim UNION ALL SELECT 'run 2', 'complete', NULL, done FROM lim
UNION ALL SELECT 'run 3', 'waiting', NULL, done FROM lim UNION ALL SELECT 'committed', 'lgd_master', NULL, done FROM lim""")
def q_g1_increment(spark, d):
    """Pages of 100 with a gap; a second run closes it and ends at a short page; a third replays both and changes nothing."""
    from civitas.schemas import SYNC_STATUS
    from civitas.sources.tables import read_latest, read_progress
    o = t(spark, d, "orders")
    page = F.floor(F.col("o_orderkey") / 100)
    n = F.lit(o.count() // 100)
    short = (page != F.floor(2 * n / 3)) | (F.col("o_orderkey") % 100 < 37)
    rec = F.struct(F.col("o_orderkey").alias("k"), F.struct(
        F.col("o_custkey").cast("string").alias("villageCode"), F.col("o_orderpriority").alias("villageNameEnglish"),
        F.col("o_orderstatus").alias("districtCode")).alias("r"))
    landed = (o.filter(short).groupBy((page * 100).cast("bigint").alias("offset")).agg(F.array_sort(F.collect_list(rec)).alias("rs"))
              .select("offset", F.to_json(F.struct(F.col("rs.r").alias("records"))).alias("body"), F.lit(1).alias("seq")))
    landed = G.stored(landed, "landed")
    # the page of the gap landed broken at first, and so did the first page, which landed again
    gap = F.floor(n / 3) * 100
    broken = landed.withColumn("body", F.substring("body", 1, 20)).withColumn("seq", F.lit(0))
    first = landed.filter(F.col("offset") != gap).unionByName(broken.filter("offset = 0"))
    base, runs = scratch_path(spark, "g1-table"), None
    for i, pages in enumerate((first, landed, landed), 1):
        done, _ = G.geography_increment(spark, base, pages, limit=100, as_of=_ts(_T1))
        row = done.select(F.lit(f"run {i}").alias("code"), F.col("state").alias("name"), F.lit(None).cast("string").alias("district"), "last_offset")
        runs = row if runs is None else runs.unionByName(row)
    status = read_progress(spark, base, spark.createDataFrame([], SYNC_STATUS).schema).select(
        F.lit("committed").alias("code"), F.col("job_name").alias("name"), F.lit(None).cast("string").alias("district"), "last_offset")
    table = read_latest(spark, base).select(F.col("village_code").alias("code"), F.col("village_name").alias("name"),
                                            F.col("district_code").alias("district"), F.lit(None).cast("bigint").alias("last_offset"))
    return table.unionByName(runs).unionByName(status)


_G2_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


@register("G2_district_load", f"""
WITH b AS (SELECT l_returnflag AS s, CAST(l_suppkey AS VARCHAR) AS dist,
    arg_max(CAST(trunc(l_quantity) AS BIGINT)+CAST(trunc(l_extendedprice) AS BIGINT), ({', '.join(_G2_ORDER)})) AS total
  FROM lineitem WHERE l_linenumber<>7 GROUP BY 1, 2),
tg AS (SELECT 'N' AS s, CAST(s_suppkey AS VARCHAR) AS dist FROM supplier)
SELECT coalesce(b.s, tg.s) AS state_name, coalesce(b.dist, tg.dist) AS district_name,
  CAST(coalesce(total, 1) AS INTEGER) AS total_population,
  CASE WHEN tg.s IS NOT NULL THEN 'orig.csv' ELSE 'NDAP_9307_source_data.csv' END AS source_file, '' AS reasons
FROM b FULL OUTER JOIN tg ON b.s=tg.s AND b.dist=tg.dist
UNION ALL SELECT NULL, CAST(l_suppkey AS VARCHAR), CAST(CAST(trunc(l_quantity) AS BIGINT)+CAST(trunc(l_extendedprice) AS BIGINT) AS INTEGER),
  NULL, 'state_null' FROM lineitem WHERE l_linenumber=7""")
def q_g2(spark, d):
    """Several archives in which districts repeat, onto a table with rows; a row without state is rejected."""
    from civitas.sources.zipped import read_zip_member_csv
    li = t(spark, d, "lineitem").select(
        F.when(F.col("l_linenumber") != 7, F.col("l_returnflag")).alias("srcStateName"),
        F.col("l_suppkey").cast("string").alias("srcDistrictName"), F.lit("2024").alias("srcYear"),
        F.col("l_quantity").cast("string").alias("Number of SC population"),
        F.col("l_extendedprice").cast("string").alias("Number of ST population"), *_G2_ORDER)
    path = _land_archives(li, F.floor(F.col("l_orderkey") / 1000), _G2_ORDER)
    rows = G.in_file_order(read_zip_member_csv(spark, path, "9307_source_data.csv", dict(G.DISTRICT_HEADERS), glob="*"))
    target = conform(spark, t(spark, d, "supplier").select(
        F.lit("N").alias("state_name"), F.col("s_suppkey").cast("string").alias("district_name"), F.lit("2024").alias("year_code"),
        F.lit(1).alias("total_population"), F.lit("orig.csv").alias("source_file")), G.DISTRICT_DEMOGRAPHICS_DDL)
    table, rejects = G.district_load(target, rows, as_of=_ts(_T1), checkpoint_batch=True)
    shown = ["state_name", "district_name", "total_population"]
    return table.select(*shown, "source_file", F.lit("").alias("reasons")).unionByName(rejects.select(
        "state_name", "district_name", F.col("total_population").cast("int").alias("total_population"),
        F.lit(None).cast("string").alias("source_file"), "reasons"))


def _summary_docs(spark, d) -> DataFrame:
    c = t(spark, d, "customer")
    m = F.col("c_nationkey") % 3
    social_total = F.struct(F.col("c_nationkey").alias("rowBoyTotal"),
                            (F.col("c_nationkey") * 2).alias("rowGirlTotal"),
                            F.when(m == 2, F.lit(1000)).alias("rowTotal"))
    social = F.when(m != 0, F.to_json(F.struct(F.struct(social_total.alias("schEnrollmentYearDataTotal")).alias("data"))))
    facility = F.when(m != 0, F.to_json(F.struct(F.struct(
        F.when(F.col("c_acctbal") > 0, F.lit(1)).otherwise(F.lit(2)).alias("internetYn")).alias("data"))))
    return c.select("c_custkey", social.alias("enrollment_social"), facility.alias("facility_data"),
                    F.lit(None).cast("string").alias("report_card"), F.lit(None).cast("string").alias("profile_data"))


@register("G6_extract_summary", """
SELECT c_custkey, CAST(CASE c_nationkey%3 WHEN 0 THEN -1 WHEN 1 THEN 3*c_nationkey ELSE 1000 END AS INTEGER)
  AS total_students, (c_nationkey%3<>0 AND c_acctbal>0) AS has_internet, -1 AS total_teachers FROM customer""")
def q_g6(spark, d):
    return extract_summary(_summary_docs(spark, d)).select("c_custkey", "total_students", "has_internet",
                                                           "total_teachers")


@register("G7_seed_reference", """
SELECT s_suppkey AS id, s_name AS name FROM supplier
UNION ALL
SELECT CAST((SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_name) AS BIGINT), c_name
FROM (SELECT DISTINCT c_name FROM customer WHERE c_name NOT IN (SELECT s_name FROM supplier)) x""")
def q_g7(spark, d):
    target = t(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    c = t(spark, d, "customer")
    seeds = c.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("seq"))
    return G.seed_reference(target, seeds, key="name", id_col="id", seq="seq")


_SECTIONS = ("SOLUTION", "COSTS", "RISKS")
_ENTRY = "struct<id: bigint, label: string, unnamed: struct<deep: array<int>>, math_dependencies: array<string>>"


def _config_docs(spark, d) -> DataFrame:
    """Configurations whose sections hold a nested field and an explicit null that no rule names."""
    o = t(spark, d, "orders")
    old = {"COSTS": '["OLD"]'}
    section = lambda n: F.concat(
        F.lit(f'"{n}": {{"id": '), F.col("o_orderkey").cast("string"), F.lit(', "label": '), jstr(F.col("o_orderpriority")),
        F.lit(', "empty": null, "unnamed": {"deep": [1, 2]}' + (f', "math_dependencies": {old[n]}' if n in old else "") + "}"))
    doc = F.concat(F.lit("{"), F.concat_ws(", ", *[section(n) for n in _SECTIONS]), F.lit("}"))
    return o.select("o_orderkey", (F.col("o_orderstatus") == "F").alias("is_default"), doc.alias("sections_config"))


def _explode_config(df: DataFrame) -> DataFrame:
    m = F.from_json("sections_config", f"map<string, {_ENTRY}>")
    ex = df.select("o_orderkey", "sections_config", F.explode(m).alias("section", "e"))
    return ex.select("o_orderkey", "section", F.array_join("e.math_dependencies", ",").alias("deps"), F.col("e.id").alias("id"),
                     F.array_join("e.unnamed.deep", "+").alias("deep"),
                     F.col("sections_config").contains('"empty":').alias("null_kept"))


def _config_sql(where_default: bool) -> str:
    parts = []
    for name in _SECTIONS:
        old = "'OLD'" if name == "COSTS" else "NULL"
        new = "'SOLUTION,BENEFICIARIES'" if name == "COSTS" else "''"
        deps = f"CASE WHEN o_orderstatus='F' THEN {new} ELSE {old} END" if where_default else new
        parts.append(f"SELECT o_orderkey, '{name}' AS section, {deps} AS deps, o_orderkey AS id, '1+2' AS deep, true AS null_kept FROM orders")
    return " UNION ALL ".join(parts)


@register("P19_json_map_set", _config_sql(False))
def q_p19(spark, d):
    docs = _config_docs(spark, d)
    docs = docs.withColumn("sections_config", J.json_map_set(
        "sections_config", "math_dependencies", {"COSTS": ["SOLUTION", "BENEFICIARIES"]}, []))
    return _explode_config(docs)


@register("G8_config_migration", _config_sql(True).replace("true AS null_kept", "true AS null_kept, '' AS reasons") + """
 UNION ALL SELECT -o_orderkey, NULL, NULL, NULL, NULL, NULL, CASE WHEN o_orderkey%14=0 THEN 'entry_not_object' ELSE 'config_not_object' END
 FROM orders WHERE o_orderstatus='F' AND o_orderkey%7=0""")
def q_g8(spark, d):
    """Default configurations migrate; a copy of every seventh whose entry is a text, or that is cut off, is rejected."""
    docs = _config_docs(spark, d)
    text = F.concat(F.expr("substr(sections_config, 1, length(sections_config) - 1)"), F.lit(', "odd": "text"}'))
    cut = F.expr("substr(sections_config, 1, length(sections_config) - 1)")
    odd = docs.filter("o_orderkey % 7 = 0").select((-F.col("o_orderkey")).alias("o_orderkey"), "is_default",
                                                   F.when(F.col("o_orderkey") % 14 == 0, text).otherwise(cut).alias("sections_config"))
    migrated, rejects = G.migrate_config(docs.unionByName(odd), "math_dependencies", {"COSTS": ["SOLUTION", "BENEFICIARIES"]}, [])
    shown = _explode_config(migrated.filter("o_orderkey >= 0")).withColumn("reasons", F.lit(""))
    return shown.unionByName(rejects.select("o_orderkey", "reasons"), allowMissingColumns=True)


def conform(spark: SparkSession, df: DataFrame, ddl: str) -> DataFrame:
    """Select ``df`` into the full table schema ``ddl`` (absent columns NULL)."""
    schema = spark.createDataFrame([], ddl).schema
    have = set(df.columns)
    return df.selectExpr(*[f"CAST({('`' + f.name + '`') if f.name in have else 'NULL'} AS "
                           f"{f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields])


def _masked(orderkey: Column) -> Column:
    return F.concat(F.lit("2912****"), F.right(F.lpad(orderkey.cast("string"), 9, "0"), F.lit(5)))


@register("G4_school_discovery", """
WITH o AS (SELECT *, (o_orderstatus='F' AND o_orderpriority='1-URGENT') AS stored, (o_orderkey%11=0) AS malformed FROM orders)
SELECT o_orderkey AS school_id,
  CASE WHEN stored AND malformed THEN '2912****' ELSE CAST(c_nationkey AS VARCHAR) END
    || right(lpad(CAST(o_orderkey AS VARCHAR), 9, '0'), 5) AS udise_code,
  CASE WHEN NOT stored THEN c_name END AS block_name,
  CASE WHEN NOT stored THEN 'C-' || CAST(c_custkey AS VARCHAR) END AS cluster_name,
  CASE WHEN stored THEN 'success' WHEN o_orderstatus='O' THEN 'closed_registry' ELSE 'pending' END AS scrape_status,
  CASE WHEN stored THEN 11 END AS effective_year,
  CASE WHEN malformed THEN NULL WHEN o_orderstatus='O' THEN 1 ELSE 0 END AS school_status,
  CASE WHEN malformed THEN NULL WHEN o_orderstatus='P' THEN 'Unknown' ELSE o_orderpriority END AS status_name,
  NOT stored AS loaded_now, '' AS reasons
FROM o JOIN customer ON c_custkey=o_custkey WHERE stored OR NOT malformed
UNION ALL
SELECT o_orderkey, CAST(c_nationkey AS VARCHAR) || right(lpad(CAST(o_orderkey AS VARCHAR), 9, '0'), 5), NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  'unreadable' FROM o JOIN customer ON c_custkey=o_custkey WHERE malformed
UNION ALL
SELECT o_custkey + 9000000000, CAST(o_orderkey//50 AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  CASE WHEN (o_orderkey//50)%50=0 THEN 'cluster_unknown' ELSE 'records_not_array' END
FROM o JOIN customer ON c_custkey=o_custkey WHERE (o_orderkey//50)%50<2 GROUP BY o_custkey, o_orderkey//50""")
def q_g4(spark, d):
    from civitas.schemas import SCHOOLS
    n, c, o = t(spark, d, "nation"), t(spark, d, "customer"), t(spark, d, "orders")
    districts = (n.groupBy(F.col("n_regionkey").alias("state_id"))
                 .agg(F.collect_list(F.struct(F.col("n_nationkey").alias("districtId"),
                                              F.col("n_name").alias("districtName"))).alias("data"))
                 .select("state_id", F.to_json(F.struct("data")).alias("body")))
    blocks = (c.groupBy(F.col("c_nationkey").alias("district_id"), (F.col("c_custkey") / 100).cast("bigint"))
              .agg(F.collect_list(F.struct(F.col("c_custkey").alias("blockId"),
                                           F.col("c_name").alias("blockName"))).alias("data"))
              .select("district_id", F.to_json(F.struct("data")).alias("body")))
    # cluster ids far beyond 2^24: an order key built by shifting them would overflow
    cluster = lambda key: F.col(key).cast("bigint") + F.lit(9_000_000_000)
    clusters = c.select(F.col("c_custkey").alias("block_id"), F.to_json(F.struct(F.array(F.struct(
        cluster("c_custkey").alias("clusterId"),
        F.concat(F.lit("C-"), F.col("c_custkey").cast("string")).alias("clusterName"))).alias("data"))).alias("body"))
    oc = o.join(c.select("c_custkey", "c_nationkey"), o["o_custkey"] == c["c_custkey"])
    status = F.when(F.col("o_orderstatus") == "F", F.lit(0)).when(F.col("o_orderstatus") == "O", F.lit(1))
    rec = F.struct(F.col("o_orderkey").alias("schoolId"), _masked(F.col("o_orderkey")).alias("udiseschCode"),
                   F.col("o_orderpriority").alias("schoolName"), status.alias("schoolStatus"),
                   F.col("o_orderpriority").alias("schoolStatusName"),
                   F.col("c_nationkey").cast("string").alias("blockCd"), F.col("o_custkey").alias("blockId"),
                   cluster("o_custkey").alias("clusterId"), F.lit("S").alias("stateName"),
                   F.when(F.col("o_orderkey") % 11 == 0, F.lit("abc")).otherwise(F.lit("560001")).alias("pincode"))
    # JSON drops null fields, so status P records have no schoolStatus / name at all
    rec_json = F.when(F.col("o_orderstatus") == "P", F.to_json(rec.dropFields("schoolStatus", "schoolStatusName"))) \
                .otherwise(F.to_json(rec))
    pages = (oc.groupBy(cluster("o_custkey").alias("cluster_id"), (F.col("o_orderkey") / 50).cast("bigint").alias("page"))
             .agg(F.collect_list(rec_json).alias("recs"))
             .select("cluster_id", "page",
                     F.concat(F.lit('{"data": {"content": ['), F.array_join("recs", ","), F.lit("]}}")).alias("body")))
    urgent_f = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    target = conform(spark, o.filter(urgent_f).select(
        F.col("o_orderkey").alias("school_id"), F.lit(12).alias("year_id"),
        _masked(F.col("o_orderkey")).alias("udise_code"), F.lit("success").alias("scrape_status"),
        F.lit(11).alias("effective_year")), SCHOOLS)
    # the same pages again under clusters that no block lists, and one in fifty without an array
    strays = pages.filter("page % 50 = 0").select((-F.col("cluster_id")).alias("cluster_id"), "page", "body")
    broken = pages.filter("page % 50 = 1").select("cluster_id", "page", F.lit('{"data": {"content": "none"}}').alias("body"))
    schools, unread = G.discovered_schools(districts, blocks, clusters, pages.unionByName(strays).unionByName(broken))
    table, rejects = G.school_discovery(target, schools, as_of=_ts(_T1))
    shown = ["school_id", "udise_code", "block_name", "cluster_name", "scrape_status", "effective_year", "school_status", "status_name"]
    loaded = table.select(*shown, F.col("last_scraped_at").isNotNull().alias("loaded_now"), F.lit("").alias("reasons"))
    refused = rejects.select("school_id", "udise_code", *[F.lit(None).cast(dict(loaded.dtypes)[c]).alias(c) for c in shown[2:]],
                             F.lit(None).cast("boolean").alias("loaded_now"), "reasons")
    pages_out = unread.select(F.abs("parent_id").alias("school_id"), F.col("page").cast("string").alias("udise_code"), "reasons")
    return loaded.unionByName(refused).unionByName(pages_out, allowMissingColumns=True)


def _enrichment_inputs(spark, d):
    from civitas.schemas import SCHOOLS
    o = t(spark, d, "orders")
    target = conform(spark, o.select(
        F.col("o_orderkey").alias("school_id"), F.lit(12).alias("year_id"),
        _masked(F.col("o_orderkey")).alias("udise_code"), F.col("o_orderpriority").alias("state_name"),
        F.lit("pending").alias("scrape_status"), F.lit(-1).alias("total_students"), F.lit(-1).alias("total_boys"),
        F.lit(-1).alias("total_girls"), F.lit(-1).alias("total_teachers"), F.lit(False).alias("has_internet"),
        F.lit(False).alias("has_library"), F.lit(False).alias("has_playground"),
        F.lit(False).alias("has_electricity")), SCHOOLS)
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    ok = lambda data: F.to_json(F.struct(F.lit(True).alias("status"), data.alias("data")))
    att = lambda ep, a, code, body, rnd=1: F.struct(
        F.lit(ep).alias("endpoint"), F.lit(a).alias("attempt"), F.lit(rnd).cast("long").alias("seq"),
        code.alias("http_status"), body.alias("body"))
    none = F.lit(None).cast("string")
    year_doc = ok(F.struct(F.lit(12).alias("yearId")))
    resolved = st != "P"
    entries = F.array(
        att("by_year", 1, F.when(st == "F", 200).otherwise(404),
            F.when((st == "F") & (pr == "2-HIGH"), F.lit('{"status": false}'))
            .when(st == "F", year_doc).otherwise(none)),
        att("by_year", 2, F.when(st == "F", 200).otherwise(404),
            F.when(st == "F", ok(F.struct(F.lit(1).alias("unused")))).otherwise(none)),
        att("probe", 1, F.when(st == "O", 200).otherwise(404), F.when(st == "O", ok(F.struct())).otherwise(none)),
        # a second fetch round: its document replaces the first round's
        att("report_card", 1, F.when(resolved, 200).otherwise(404), ok(F.struct(F.lit(900).alias("totalTeacher"))), 0),
        att("social_1", 1, F.when(resolved & (pr != "3-MEDIUM"), 200).otherwise(404), ok(F.struct(F.struct(
            (F.col("o_custkey") % 7).alias("rowBoyTotal"), (F.col("o_orderkey") % 5).alias("rowGirlTotal"))
            .alias("schEnrollmentYearDataTotal")))),
        att("report_card", 1, F.when(resolved, 200).otherwise(404), ok(F.struct(
            (F.col("o_custkey") % 10).alias("totMale"), (F.col("o_orderkey") % 10).alias("totFemale")))),
        att("facility_data", 1, F.when(resolved, 200).otherwise(404), ok(F.struct(
            F.when(F.col("o_totalprice") > 100000, F.lit(1)).otherwise(F.lit(2)).alias("internetYn"),
            F.when(F.col("o_custkey") % 2 == 0, F.lit(1)).otherwise(F.lit(2)).alias("libraryYn"),
            (F.col("o_custkey") % 3).alias("playgroundYn"), F.lit("1").alias("electricityYn")))),
        att("profile_data", 1, F.when(resolved & (pr != "5-LOW"), 200).otherwise(404),
            ok(F.struct(F.col("o_custkey").alias("lgdwardId"), F.lit("W").alias("lgdwardName"),
                        F.col("o_orderkey").alias("lgdurbanlocalbodyId"), F.lit("U").alias("lgdurbanlocalbodyName")))),
    )
    responses = (o.select(F.col("o_orderkey").alias("school_id"), "o_orderstatus",
                          F.explode(entries).alias("r"))
                 # a school the registry has not got (status P) yields no fragment requests
                 .filter((F.col("o_orderstatus") != "P") | F.col("r.endpoint").isin("by_year", "probe"))
                 .select("school_id", "r.endpoint", "r.attempt", "r.seq", "r.http_status", "r.body"))
    return target, responses


def _g5_sql(touched: str) -> str:
    """What G5 makes of :func:`_enrichment_inputs`; rows outside ``touched`` keep their stored values."""
    done, known = f"(({touched}) AND o_orderstatus<>'P')", f"(({touched}) AND o_orderstatus<>'P' AND o_orderpriority<>'5-LOW')"
    social = f"({done} AND o_orderpriority<>'3-MEDIUM')"
    return f"""
SELECT o_orderkey AS school_id, CASE WHEN NOT ({touched}) THEN NULL WHEN o_orderstatus='F' THEN 12 WHEN o_orderstatus='O' THEN 11 END AS effective_year,
  CASE WHEN ({touched}) AND o_orderstatus='O' THEN 11 ELSE 12 END AS year_id,
  CASE WHEN NOT ({touched}) THEN 'pending' WHEN o_orderstatus='P' THEN 'missing_on_server' WHEN o_orderpriority<>'5-LOW' THEN 'success'
       ELSE 'partial' END AS scrape_status,
  CAST(CASE WHEN {done} THEN o_custkey%10 + o_orderkey%10 ELSE -1 END AS INTEGER) AS total_teachers,
  CAST(CASE WHEN {social} THEN o_custkey%7 ELSE -1 END AS INTEGER) AS total_boys,
  CAST(CASE WHEN {social} THEN o_orderkey%5 ELSE -1 END AS INTEGER) AS total_girls,
  CAST(CASE WHEN {social} THEN o_custkey%7 + o_orderkey%5 ELSE -1 END AS INTEGER) AS total_students,
  ({done} AND o_totalprice>100000) AS has_internet, ({done} AND o_custkey%2=0) AS has_library,
  ({done} AND o_custkey%3=1) AS has_playground, false AS has_electricity,
  CASE WHEN {done} THEN '{{"basic_info":200,"facility_data":200,"profile_data":' ||
    CASE WHEN o_orderpriority<>'5-LOW' THEN '200' ELSE '404' END || ',"report_card":200,"social_1":' ||
    CASE WHEN o_orderpriority<>'3-MEDIUM' THEN '200' ELSE '404' END || '}}' END AS enrichment_manifest,
  CASE WHEN {known} THEN CAST(o_custkey AS VARCHAR) END AS lgd_ward_id, CASE WHEN {known} THEN 'W' END AS lgd_ward_name,
  CASE WHEN {known} THEN CAST(o_orderkey AS VARCHAR) END AS lgd_urban_local_body_id,
  CASE WHEN {known} THEN 'U' END AS lgd_urban_local_body_name
FROM orders"""


_G5_SHOWN = ("school_id", "effective_year", "year_id", "scrape_status", "enrichment_manifest", *G.SUMMARY_COLUMNS)


@register("G5_school_enrichment", _g5_sql("true"))
def q_g5(spark, d):
    target, responses = _enrichment_inputs(spark, d)
    return G.school_enrichment(target, responses, as_of=_ts(_T1)).select(*_G5_SHOWN)


@register("G5_enrich_state", _g5_sql("o_orderpriority='5-LOW'"))
def q_g5_state(spark, d):
    target, responses = _enrichment_inputs(spark, d)
    table, _ = G.enrich_state(target, responses, "5-LOW", as_of=_ts(_T1))
    return table.select(*_G5_SHOWN)


@register("G9_run_loads", _AMENITIES_SQL)
def q_g9(spark, d):
    from civitas.sources.csv import write_csv
    raw = _amenities_raw(spark, d)
    base = scratch_path(spark, "g9")
    write_csv(raw, f"{base}/landing")
    steps = {
        "amenities": lambda s, path: G.amenities_load(s, path, raw.columns, f"{base}/raw"),
        "district_stats": lambda s, path: s.read.csv(path),
    }
    out = G.run_loads(spark, steps, {"amenities": f"{base}/landing", "district_stats": f"{base}/absent.zip"})
    assert str(out["district_stats"]).startswith("skipped"), out["district_stats"]
    return out["amenities"]


@register("S7_incremental_buckets", """
SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY 1""")
def q_s7b(spark, d):
    """S7 in bucket mode: each micro-batch rewrites only the key buckets it touches."""
    from civitas.sources.tables import read_buckets
    from civitas.streaming.incremental import incremental_upsert
    base = scratch_path(spark, "s7b")
    o = t(spark, d, "orders").select("o_custkey", "o_totalprice", "o_orderkey")
    q1, q2 = o.approxQuantile("o_orderkey", [1 / 3, 2 / 3], 0.01)
    cuts = [F.col("o_orderkey") < q1, (F.col("o_orderkey") >= q1) & (F.col("o_orderkey") < q2),
            F.col("o_orderkey") >= q2]
    for i, cond in enumerate(cuts):
        o.filter(cond).write.mode("overwrite").json(f"{base}/landing/part-{i}")
    incremental_upsert(
        spark, f"{base}/landing/*", "o_custkey long, o_totalprice double, o_orderkey long",
        f"{base}/target", "o_custkey long, price double", f"{base}/checkpoint", "o_custkey",
        {"price": U.OVERWRITE}, seq="o_orderkey",
        prepare=lambda b: b.select("o_custkey", F.col("o_totalprice").alias("price"), "o_orderkey"),
        max_files_per_trigger=8, num_buckets=64)
    return read_buckets(spark, f"{base}/target")


@register("S1_csv_positional_rejects", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id%10<>0 THEN lang END AS lang,
  CASE WHEN doc_id%10<>0 THEN source END AS source, (doc_id%10=0) AS rejected FROM documents""")
def q_s1_rejects(spark, d):
    """Rows with a wrong field count go to rejects; the rest loads by position."""
    from civitas.sources.csv import read_csv_positional
    docs = t(spark, d, "documents")
    q = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", F.col("doc_id").cast("string"), q(F.col("lang")), q(F.col("source")))
    # every tenth document carries a stray extra field
    line = F.when(F.col("doc_id") % 10 == 0, F.concat(line, F.lit(",extra"))).otherwise(line)
    path = scratch_path(spark, "s1r")
    docs.select(line.alias("value")).write.mode("overwrite").text(f"{path}/rows")
    good, bad = read_csv_positional(spark, f"{path}/rows", ["doc_id", "lang", "source"], on_bad="reject",
                                    header=False)
    shown = bad.select(F.split("_corrupt_record", ",")[0].alias("doc_id"), F.lit(None).cast("string").alias("lang"),
                       F.lit(None).cast("string").alias("source"), F.lit(True).alias("rejected"))
    return good.withColumn("rejected", F.lit(False)).unionByName(shown)


@register("U1_upsert_buckets", """
SELECT c_custkey, CASE WHEN c_nationkey>=7 THEN -c_acctbal ELSE c_acctbal END AS bal,
  CASE WHEN c_nationkey<13 THEN c_mktsegment ELSE 'NEW' END AS seg FROM customer""")
def q_u1_buckets(spark, d):
    """U1/U2 into a bucket-partitioned table: the batch rewrites only its buckets."""
    from civitas.sources.tables import apply_to_buckets, bucket_of, merge_into_buckets, read_buckets
    target, batch = _cust_target_batch(spark, d)
    target = target.select("c_custkey", "bal", "seg")
    path = scratch_path(spark, "u1b")
    apply_to_buckets(spark, path, target, "c_custkey",
                     lambda _: target.withColumn("_bucket", bucket_of(["c_custkey"], 32, target.schema)),
                     target.schema, 32)
    merge_into_buckets(spark, path, batch, "c_custkey", {"bal": U.OVERWRITE, "seg": U.KEEP}, target.schema,
                       num_buckets=32)
    return read_buckets(spark, path)


@register("S1_csv_split_positional", """
WITH f AS (SELECT doc_id, text, doc_id%10=0 AS bad FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN NOT bad THEN text||chr(10)||'"'||coalesce(lang, '')||'",' END AS text,
  CASE WHEN NOT bad THEN source END AS source, bad AS rejected FROM (SELECT f.*, lang, source FROM f JOIN documents USING (doc_id))""")
def q_s1_split(spark, d):
    """One file with newlines, quotes and commas inside quotes, read in ranges by many tasks; bad rows in the rejects."""
    from civitas.sources.csv import read_csv_positional
    docs = t(spark, d, "documents")
    q = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    text = F.concat(F.col("text"), F.lit('\n"'), F.coalesce("lang", F.lit("")), F.lit('",'))
    line = F.concat_ws(",", F.col("doc_id").cast("string"), q(text), q(F.col("source")))
    line = F.when(F.col("doc_id") % 10 == 0, F.concat(line, F.lit(",extra"))).otherwise(line)
    path = scratch_path(spark, "s1s")
    docs.select(line.alias("value")).write.text(path)
    good, bad = read_csv_positional(spark, path, ["doc_id", "text", "source"], on_bad="reject", header=False, split=True)
    none = F.lit(None).cast("string")
    shown = bad.select(F.split("_corrupt_record", ",")[0].alias("doc_id"), none.alias("text"), none.alias("source"), F.lit(True).alias("rejected"))
    return good.withColumn("rejected", F.lit(False)).unionByName(shown)
