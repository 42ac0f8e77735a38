"""End-to-end registry jobs (G1-G5, G7-G9) composed from the operators.

Every job is ``inputs -> DataFrames``: it returns the new table (and the
rejects); writing it as a new version is the caller's step (see
:mod:`civitas.sources.tables`). Jobs that number new rows (G1, G7) store the
folded batch and run the numbering while they are built; the others only plan. ``as_of`` pins load-time stamps so results
are reproducible; it defaults to ``current_timestamp()``. Jobs returning
``(table, rejects)`` take ``checkpoint_batch=True`` when the caller writes
both: the parsed batch is then materialised once instead of twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civitas.functions.cleaning import clean_int, completeness, lookup_code, row_sum, unmask_code
from civitas.functions.json import initial_status, json_is_object, json_map_set, json_or, truthy_text, variant
from civitas.operators.audit import fits
from civitas.operators.dedupe import work_queue
from civitas.operators.ids import assign_ids, resume_offset
from civitas.operators.joins import effective_year, expand_hierarchy
from civitas.operators.responses import manifest_of, resolve_attempts_wide
from civitas.operators.upsert import (KEEP, OVERWRITE, custom, fold_for, insert_absent, split_rejects, stamp, sticky,
                                      upsert)
from civitas.plans.summary import extract_summary
from civitas.schemas import DISTRICT_DEMOGRAPHICS, FRAGMENT_COLUMNS, LGD_MASTER, SYNC_STATUS
from civitas.sources.envelope import parse_bodies, parsed_records, plain_keys, record_struct, rejected_bodies
from civitas.sources.records import stored


LGD_MASTER_DDL = LGD_MASTER
DISTRICT_DEMOGRAPHICS_DDL = DISTRICT_DEMOGRAPHICS


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.localtimestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")


# ----------------------------------------------------------------- G1 geography

# Geography record keys -> lgd_master columns.
LGD_FIELDS = {
    "village_code": "villageCode",
    "village_name": "villageNameEnglish",
    "subdistrict_code": "subdistrictCode",
    "subdistrict_name": "subdistrictNameEnglish",
    "district_code": "districtCode",
    "district_name": "districtNameEnglish",
    "state_code": "stateCode",
    "state_name": "stateNameEnglish",
}


def geography_bodies(pages: DataFrame, page_col: str = "page", body_col: str = "body") -> DataFrame:
    """The landed pages parsed once and stored: records or reasons (``page_null``, ``invalid_body``, ``records_not_array``)."""
    return stored(parse_bodies(pages, body_col, "$.records", {"page_null": F.col(page_col).isNull()}), "g1-bodies")


def geography_records(parsed: DataFrame, page_col: str = "page") -> DataFrame:
    """S4 + P14: one row per record of :func:`geography_bodies`, with ``seq``."""
    recs = parsed_records(parsed, dict(LGD_FIELDS), keep=[page_col])
    return recs.select(
        *LGD_FIELDS.keys(), truthy_text(F.col("record"), "$.pincode").alias("pincode"),
        (F.col(page_col).cast("bigint") * F.lit(1 << 32) + F.col("record_index")).alias("seq"))


def geography_sync(target: DataFrame, pages: DataFrame, as_of=None,
                   page_col: str = "page", checkpoint_batch: bool = False) -> tuple[DataFrame, DataFrame]:
    """G1: upsert landed geography pages into ``lgd_master`` -> ``(table, rejects)``.

    Names and pincode are overwritten by the last record of a code, the three
    parent codes are kept from the first insert, ``last_updated`` restamped.
    A record without a code (or longer than 50) is rejected alone instead of
    failing its page; a page without a number, that is no JSON or whose
    ``records`` is no array is rejected as a page. New rows get ids after the
    current maximum. Pages are parsed once and stored, the records folded
    once, into a stored batch of one row per code; numbering and upsert read
    that batch.
    """
    return sync_parsed(target, geography_bodies(pages, page_col), as_of, page_col, checkpoint_batch)


def sync_parsed(target: DataFrame, parsed: DataFrame, as_of=None, page_col: str = "page",
                checkpoint_batch: bool = False) -> tuple[DataFrame, DataFrame]:
    """:func:`geography_sync` of pages that are parsed already."""
    recs = geography_records(parsed, page_col)
    good, rejects = split_rejects(recs, {
        "village_code_null": F.col("village_code").isNull(),
        "village_code_length": ~fits("village_code", "varchar(50)"),
    }, checkpoint=checkpoint_batch)
    as_of_col = _as_of(as_of)
    rules = {c: OVERWRITE for c in ("village_name", "subdistrict_name", "district_name", "state_name", "pincode")}
    rules["last_updated"] = stamp(as_of_col)
    folded = stored(fold_for(good, "village_code", rules, "seq").drop("seq"), "g1-batch")
    numbered = numbered_keys(folded, target, "village_code", "id")
    batch = folded.join(numbered, "village_code", "left").withColumn("last_updated", as_of_col)
    table = upsert(target, batch, "village_code", rules)
    return table, rejects.unionByName(rejected_bodies(parsed).select(page_col, "body", "reasons"), allowMissingColumns=True)


def contiguous_prefix(pages: DataFrame, start: int, limit: int) -> tuple[int, int, str]:
    """(pages to apply, offset behind them, state) of landed pages ``(offset, ok, n)``, one row per offset.

    Page by page from ``start``: a full page leads to the one ``limit``
    records on; a short one is the last, an empty one not even that
    (``complete``); an unreadable one is asked for again (``restart``); a page
    that has not landed is waited for (``waiting``). Decided by aggregates and
    one anti join over page numbers, whatever their number.
    """
    at = (F.col("offset") - F.lit(start)) / F.lit(limit)
    here = pages.filter((F.col("offset") >= start) & ((F.col("offset") - start) % limit == 0)).select(at.cast("bigint").alias("i"), "ok", "n")
    full = F.col("ok") & (F.col("n") >= limit)
    wanted = here.filter(full).select((F.col("i") + 1).alias("i")).unionByName(pages.sparkSession.range(1).select(F.col("id").alias("i")))
    missing = wanted.join(here, "i", "left_anti").agg(F.min("i")).first()[0]
    stop = here.filter(~full).agg(F.min(F.struct("i", "ok", "n"))).first()[0]
    if stop is None or (missing is not None and missing <= stop["i"]):
        end, state = missing, "waiting"
    elif not stop["ok"]:
        end, state = stop["i"], "restart"
    else:
        end, state = stop["i"] + (stop["n"] > 0), "complete"
    consumed = here.filter(F.col("i") < end).agg(F.sum("n")).first()[0] or 0
    return end, start + consumed, state


def geography_increment(spark: SparkSession, base: str, landed: DataFrame, job: str = "lgd_master", limit: int = 1000,
                        as_of=None) -> tuple[DataFrame, DataFrame]:
    """G1 with offset and stop rule: the unbroken run of landed pages goes into the table at ``base`` -> ``(progress, rejects)``.

    ``landed``: ``offset, body`` and optionally ``seq`` (landing order), one
    row per landed response; of several for an offset the last readable one
    counts. The job goes on at its committed offset, or at the table's count
    cut down to whole pages (A1), applies :func:`contiguous_prefix` and commits
    rows, offset and counters (A6) together; what lies behind a gap waits for a later run. A
    run with nothing to apply writes nothing, so a replay changes nothing.
    ``progress``: ``job_name, start_offset, last_offset, pages, state``.
    """
    from civitas.sources.tables import commit_run, read_latest, read_progress
    schema = {n: spark.createDataFrame([], ddl).schema for n, ddl in (("table", LGD_MASTER), ("status", SYNC_STATUS))}
    target, status = read_latest(spark, base, schema["table"]), read_progress(spark, base, schema["status"])
    start = resume_offset(status, target, job, limit).first()["offset"]
    rows = landed if "seq" in landed.columns else landed.withColumn("seq", F.lit(0))
    rows = rows.filter(F.col("offset").isNull() | (F.col("offset") >= start)).withColumn("page", F.floor(F.col("offset") / limit))
    parsed = stored(parse_bodies(rows, "body", "$.records", {"offset_null": F.col("offset").isNull()}), "g1-bodies")
    decided = parsed.filter("offset IS NOT NULL").groupBy("offset").agg(
        F.max(F.struct((F.col("reasons") == "").alias("ok"), "seq", F.coalesce(F.size("records"), F.lit(0)).alias("n"))).alias("b"))
    decided = stored(decided.select("offset", "b.*"), "g1-pages")
    pages, last, state = contiguous_prefix(decided, start, limit)
    applied = decided.filter((F.col("offset") < start + pages * limit) & ((F.col("offset") - start) % limit == 0)).select("offset", "seq")
    table, rejects = sync_parsed(target, parsed.join(applied, ["offset", "seq"], "left_semi").drop("seq"), as_of)
    rejects = stored(rejects.filter("body IS NULL"), "g1-rejects")
    if pages:
        row = spark.range(1).select(F.lit(job).alias("job_name"), F.lit(last).cast("bigint").alias("last_offset"), _as_of(as_of).alias("last_updated"))
        commit_run(table, base, f"{job}-{start}-{last}", job, read=last - start, rejects=rejects,
                   progress=status.filter(F.col("job_name") != job).unionByName(row))
    progress = spark.createDataFrame([(job, start, last, pages, state)], "job_name string, start_offset long, last_offset long, pages long, state string")
    unread = rejected_bodies(parsed).select("page", "body", "reasons")
    return progress, rejects.unionByName(unread, allowMissingColumns=True)


def numbered_keys(batch: DataFrame, target: DataFrame, key: str, id_col: str) -> DataFrame:
    """(key, id) of the batch's keys that the target lacks, numbered after ``MAX(id)``."""
    new_keys = batch.select(key).filter(F.col(key).isNotNull()).distinct().join(target.select(key), key, "left_anti")
    ids = assign_ids(new_keys, target, id_col, [key])
    return ids.select(key, F.col(id_col).cast(dict(target.dtypes)[id_col]).alias(id_col))


def number_new_rows(merged: DataFrame, target: DataFrame, batch: DataFrame, key: str, id_col: str) -> DataFrame:
    """Give rows the upsert inserted a surrogate id after ``MAX(id)`` (SERIAL).

    Only the new keys (batch keys absent from the target's key column) are
    numbered, so the sort and checkpoint behind the dense numbering are
    batch-sized; the ids reach the table through one join on the key the
    upsert already partitioned by.
    """
    numbered = numbered_keys(batch, target, key, id_col).withColumnRenamed(id_col, f"__new_{id_col}")
    out = merged.join(numbered, key, "left")
    return out.withColumn(id_col, F.coalesce(F.col(id_col), F.col(f"__new_{id_col}")).cast(
        dict(target.dtypes)[id_col])).select(*target.columns)


def sync_status_row(spark: SparkSession, job: str, offset: DataFrame, consumed: DataFrame, as_of=None) -> DataFrame:
    """The offset row a sync leaves: start offset plus records consumed."""
    n = consumed.agg(F.count(F.lit(1)).alias("__n"))
    both = offset.select(F.col("offset").alias("__v")).unionByName(n.select(F.col("__n").alias("__v")))
    return both.agg(F.sum("__v").cast("bigint").alias("last_offset")).select(
        F.lit(job).alias("job_name"), "last_offset", _as_of(as_of).alias("last_updated"))


# ------------------------------------------------------ G2 district statistics

# Header names of the district statistics file.
DISTRICT_HEADERS = {
    "srcStateName": "string",
    "srcDistrictName": "string",
    "srcYear": "string",
    "Number of SC population": "string",
    "Number of ST population": "string",
    "Number of general population": "string",
}
DISTRICT_SOURCE_FILE = "NDAP_9307_source_data.csv"


def district_rows(spark: SparkSession, path: str, member_like: str = "9307_source_data.csv") -> DataFrame:
    """The district statistics under ``path``, zip archives (``*.zip``) or plain CSV files.

    ``line_no`` is the pair (file, line): a total order over several files, in
    which the later file wins where a district repeats.
    """
    if path.rstrip("/").endswith(".zip"):
        from civitas.sources.zipped import read_zip_member_csv
        rows = read_zip_member_csv(spark, path, member_like, DISTRICT_HEADERS)
    else:
        from civitas.sources.csv import read_csv_named
        rows = read_csv_named(spark, path, DISTRICT_HEADERS, positions=True)
    return in_file_order(rows)


def in_file_order(rows: DataFrame) -> DataFrame:
    """``source_path`` and ``line_no`` as one ordering column ``line_no``."""
    return rows.withColumn("line_no", F.struct("source_path", "line_no")).drop("source_path", "member")


def district_load(target: DataFrame, rows: DataFrame, seq: str = "line_no", as_of=None,
                  source_file: str = DISTRICT_SOURCE_FILE,
                  checkpoint_batch: bool = False) -> tuple[DataFrame, DataFrame]:
    """Clean, total, reject, fold and upsert district statistics -> ``(table, rejects)``.

    ``rows`` carries the header-named text columns and an ordering ``seq``.
    Counts are lenient integers (P10); the total is their row sum (P11).
    Only a bad row is rejected (null key part, count beyond INTEGER) -- the
    rest of the load goes on. With ``checkpoint_batch`` the cleaned rows are
    stored, and rules, fold and rejects read the numbers from there.
    """
    c = (rows.select(
        F.col("srcStateName").alias("state_name"), F.col("srcDistrictName").alias("district_name"),
        F.col("srcYear").cast("string").alias("year_code"),
        clean_int(F.col("`Number of SC population`")).alias("sc_population"),
        clean_int(F.col("`Number of ST population`")).alias("st_population"),
        clean_int(F.col("`Number of general population`")).alias("general_population"),
        F.col(seq).alias("__seq"))
        .withColumn("total_population", row_sum("sc_population", "st_population", "general_population")))
    if checkpoint_batch:
        c = stored(c, "g2-batch")
    good, rejects = split_rejects(c, {
        "state_null": F.col("state_name").isNull(),
        "district_null": F.col("district_name").isNull(),
        "year_null": F.col("year_code").isNull(),
        "out_of_range": ~(fits("total_population", "int") & fits("sc_population", "int")
                          & fits("st_population", "int") & fits("general_population", "int")),
    })
    batch = good.withColumn("source_file", F.lit(source_file)).withColumn("created_at", _as_of(as_of))
    rules = {k: OVERWRITE for k in ("total_population", "sc_population", "st_population", "general_population")}
    rules["created_at"] = stamp(_as_of(as_of))
    rules["source_file"] = KEEP
    merged = upsert(target, batch, ["state_name", "district_name", "year_code"], rules, seq="__seq")
    return merged, rejects


# ----------------------------------------------------------- G3 amenities

def amenities_load(spark: SparkSession, csv_path: str, columns: Sequence[str], raw_path: str) -> DataFrame:
    """Positional CSV -> append to the raw table -> amenities view over it.

    A file is read by many tasks, newlines inside quotes included. ``columns``
    are all column names of the file in their order.
    """
    from civitas.plans.views import view_village_amenities
    from civitas.sources.csv import read_csv_positional
    from civitas.sources.tables import append_table
    append_table(read_csv_positional(spark, csv_path, columns, split=True), raw_path)
    return view_village_amenities(spark.read.parquet(raw_path))


# --------------------------------------------------------- G4 school discovery

# State name -> registry state id for discovery.
STATE_IDS = {
    "KARNATAKA": 129,
    "GOA": 130,
    "KERALA": 132,
    "ANDHRA PRADESH": 128,
    "TAMILNADU": 133,
    "TELANGANA": 136,
}
CURRENT_YEAR_ID = 12
FALLBACK_YEAR_ID = 11

# School record key -> school table column (discovery).
SCHOOL_FIELDS = {
    "school_id": ("schoolId", "bigint"), "school_name": "schoolName",
    "last_modified": ("lastmodifiedTime", "timestamp_ntz"),
    "state_id": ("stateId", "bigint"), "state_cd": "stateCd", "state_name": "stateName",
    "district_id": ("districtId", "bigint"), "district_cd": "districtCd", "district_name": "districtName",
    "block_id": ("blockId", "bigint"), "block_cd": "blockCd",
    "cluster_id": ("clusterId", "bigint"), "cluster_cd": "clusterCd",
    "village_id": ("villageId", "bigint"), "vill_ward_cd": "villWardCd", "village_name": "villageName",
    "pincode": ("pincode", "int"), "address": "address", "email": "email",
    "lgd_state_id": ("lgdStateId", "int"), "lgd_district_id": ("lgdDistrictCd", "int"),
    "lgd_block_id": ("lgdBlockId", "int"), "lgd_village_id": "lgdvillageId", "lgd_vill_name": "lgdvillName",
    "lgd_panchayat_id": "lgdpanchayatId", "lgd_vill_panchayat_name": "lgdvillpanchayatName",
    "sch_loc_rural_urban": ("schLocRuralUrban", "int"), "sch_loc_desc": "schLocDesc",
    "sch_category_id": ("schCategoryId", "int"), "sch_cat_desc": "schCatDesc",
    "sch_type": ("schType", "int"), "sch_type_desc": "schTypeDesc",
    "sch_mgmt_id": ("schMgmtId", "int"), "sch_mgmt_desc": "schMgmtDesc",
    "sch_mgmt_parent_id": ("schmgmtParentId", "int"), "sch_mgmt_desc_st": "schMgmtDescSt",
    "sch_broad_mgmt_id": ("schBroadMgmtId", "int"), "class_frm": ("classFrm", "int"), "class_to": ("classTo", "int"),
    "is_operational_2018_to_19": ("isOperational2018To19", "int"),
    "is_operational_2019_to_20": ("isOperational2019To20", "int"),
    "is_operational_2020_to_21": ("isOperational2020To21", "int"),
    "is_operational_2021_to_22": ("isOperational2021To22", "int"),
    "is_operational_2022_to_23": ("isOperational2022To23", "int"),
}
# Columns a later discovery run overwrites.
DISCOVERY_OVERWRITE = ("udise_code", "school_name", "school_status", "status_name", "last_modified",
                       "is_operational_2018_to_19", "is_operational_2019_to_20", "is_operational_2020_to_21",
                       "is_operational_2021_to_22", "is_operational_2022_to_23")


def state_id(col: Column | str) -> Column:
    """P22 for discovery: case-insensitive state name -> id (unknown -> NULL)."""
    return lookup_code(col, STATE_IDS)


def state_id_of(name: str) -> int:
    """P22 for a job parameter: an unknown state is an error before any work."""
    try:
        return STATE_IDS[name.upper()]
    except KeyError:
        raise ValueError(f"invalid state: {name!r}") from None


def discovered_schools(districts: DataFrame, blocks: DataFrame, clusters: DataFrame,
                       school_pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S5 + J2 + P12 + P13: school rows and rejects from landed hierarchy responses.

    Inputs are landed bodies keyed by their request parent:
    ``districts(state_id, body)`` with ``data[]``, ``blocks(district_id, body)``,
    ``clusters(block_id, body)`` with ``data[]`` and
    ``school_pages(cluster_id, page, body)`` with ``data.content[]``.

    Every body is parsed once, all levels in one stored frame; the school rows
    are stored too, so that good rows and rejects read them and each input is
    read once. ``seq`` is the request order (district, block, cluster, page,
    record); ``unreadable`` names the fields whose value is present but not of
    the column's type. Rejects ``(level, parent_id, page, body, reasons)``:
    bodies that are no JSON (``invalid_body``) or hold no array
    (``records_not_array``), pages whose cluster no block lists
    (``cluster_unknown``).
    """
    landed = {"district": (districts, "state_id", "$.data"), "block": (blocks, "district_id", "$.data"),
              "cluster": (clusters, "block_id", "$.data"), "school": (school_pages, "cluster_id", "$.data.content")}
    bodies = None
    for level, (df, parent, path) in landed.items():
        page = F.col("page") if level == "school" else F.lit(None)
        part = parse_bodies(df.select(F.lit(level).alias("level"), F.col(parent).cast("bigint").alias("parent_id"),
                                      page.cast("bigint").alias("page"), "body"), "body", path)
        bodies = part if bodies is None else bodies.unionByName(part)
    bodies = stored(bodies, "g4-bodies")

    def level_rows(level: str, child: str) -> DataFrame:
        rows = parsed_records(bodies.filter(F.col("level") == level), {f"h_{level}_id": (f"{level}Id", "bigint"), f"h_{level}_name": f"{level}Name"},
                              keep=["parent_id"])
        return rows.select(F.col("parent_id").alias(child), f"h_{level}_id", f"h_{level}_name", F.col("record_index").alias(f"i_{level}"))

    levels = [(level_rows("district", "state_id"), None, "h_district_id"), (level_rows("block", "p_district_id"), "p_district_id", "h_block_id"),
              (level_rows("cluster", "p_block_id"), "p_block_id", "h_cluster_id")]
    hier = expand_hierarchy(levels).select("h_cluster_id", "h_block_name", "h_cluster_name",
                                           "i_district", "i_block", "i_cluster")
    pages = bodies.filter("level = 'school' AND reasons = ''")
    joined = pages.join(hier, F.col("parent_id") == F.col("h_cluster_id"))     # pages, before their records are exploded
    place = F.struct("i_district", "i_block", "i_cluster", F.col("parent_id").alias("cluster"), "page", "record_index")
    rows = parsed_records(joined, dict(SCHOOL_FIELDS),
                          keep=["parent_id", "page", "h_block_name", "h_cluster_name", "i_district", "i_block", "i_cluster"])
    rows = with_unreadable(rows, "record", SCHOOL_FIELDS)
    st = initial_status(F.col("record"))
    schools = rows.select(
        *[F.col(k) for k in SCHOOL_FIELDS],
        F.lit(CURRENT_YEAR_ID).alias("year_id"),
        unmask_code(F.try_variant_get("record", "$.udiseschCode", "string"),
                    F.col("block_cd")).alias("udise_code"),
        st["school_status"].alias("school_status"), st["status_name"].alias("status_name"),
        st["scrape_status"].alias("scrape_status"),
        F.col("h_block_name").alias("block_name"), F.col("h_cluster_name").alias("cluster_name"),
        place.alias("seq"), F.col("unreadable"))
    known = hier.select(F.col("h_cluster_id").alias("parent_id")).distinct()
    unlisted = pages.join(known, "parent_id", "left_anti").withColumn("reasons", F.lit("cluster_unknown"))
    shown = ["level", "parent_id", "page", "body", "reasons"]
    return stored(schools, "g4-schools"), rejected_bodies(bodies).select(*shown).unionByName(unlisted.select(*shown))


def with_unreadable(rows: DataFrame, record: str, fields: Mapping[str, tuple[str, str] | str]) -> DataFrame:
    """``rows`` with ``unreadable``: comma list of the typed fields whose JSON value is present, not null, and not of the type."""
    typed = {name: spec for name, spec in fields.items() if not isinstance(spec, str) and spec[1] != "string"}
    plain = plain_keys(typed.values())
    tests = []
    for name, (key, typ) in typed.items():
        x = f"__present.`{key}`" if key in plain else f"variant_get({record}, '$.{key}', 'variant')"
        read = f"__typed.`{key}`" if key in plain else f"try_variant_get({x}, '$', '{typ}')"
        tests.append(f"CASE WHEN {x} IS NOT NULL AND NOT is_variant_null({x}) AND {read} IS NULL THEN '{name}' END")
    # two walks over a record tell for all fields
    out = rows.withColumn("__typed", record_struct(record, plain)).withColumn("__present", record_struct(record, dict.fromkeys(plain, "variant")))
    return out.withColumn("unreadable", F.expr(f"concat_ws(',', {', '.join(tests)})") if tests else F.lit("")).drop("__typed", "__present")


def school_discovery(target: DataFrame, schools: DataFrame, as_of=None,
                     checkpoint_batch: bool = False) -> tuple[DataFrame, DataFrame]:
    """Upsert discovered schools on (school_id, year_id) -> ``(table, rejects)``.

    Rows without an unmasked code are skipped (reported in rejects).
    ``effective_year`` keeps the stored value unless NULL; a stored
    ``success`` status is sticky; ten columns overwrite; the rest is
    insert-only, ``last_scraped_at`` with the load time. A row with a value
    that its column cannot hold is rejected (``unreadable``).
    """
    if "unreadable" not in schools.columns:
        schools = schools.withColumn("unreadable", F.lit(""))
    good, rejects = split_rejects(schools, {
        "school_id_null": F.col("school_id").isNull(),
        "no_code": F.col("udise_code").isNull(),
        "code_length": ~fits("udise_code", "varchar(11)"),
        "unreadable": F.col("unreadable") != F.lit(""),
    }, checkpoint=checkpoint_batch)
    rules = {c: OVERWRITE for c in DISCOVERY_OVERWRITE}
    rules["scrape_status"] = sticky("success")
    rules["effective_year"] = custom(lambda old, new: F.coalesce(old, new))
    batch = good.withColumn("effective_year", F.lit(None).cast("int")).withColumn("last_scraped_at", _as_of(as_of))
    return upsert(target, batch, ["school_id", "year_id"], rules, seq="seq"), rejects


# -------------------------------------------------------- G5 school enrichment

# The eight fragment endpoints fetched after the year is known.
FRAGMENT_ENDPOINTS = ("report_card", "facility_data", "profile_data",
                      "social_1", "social_2", "social_3", "social_4", "social_5")
PRIMARY_ENDPOINT = "by_year"
PROBE_ENDPOINT = "probe"


def enrichment_rejects(responses: DataFrame, max_attempts: int = 2) -> DataFrame:
    """(school_id, body, reasons): schools whose primary document has ``"data": null``; they stay as they are."""
    w = resolve_attempts_wide(responses, "school_id", [PRIMARY_ENDPOINT], max_attempts=max_attempts)
    body = F.col(f"{PRIMARY_ENDPOINT}_body")
    return w.filter((F.col(f"{PRIMARY_ENDPOINT}_code") == 200) & _null_data(variant(body))).select(
        "school_id", body.alias("body"), F.lit("primary_data_null").alias("reasons"))


def _null_data(doc: Column) -> Column:
    return F.coalesce(F.is_variant_null(F.variant_get(doc, "$.data", "variant")), F.lit(False))


def school_enrichment(target: DataFrame, responses: DataFrame, as_of=None,
                      max_attempts: int = 2) -> DataFrame:
    """Resolve landed responses and fold them into the school table.

    ``responses``: ``school_id, endpoint, attempt, seq, http_status, body``
    with endpoints ``by_year``, ``probe`` (the fallback-year report card) and
    the eight fragments. Per school: A5 resolves attempts, J5 the effective
    year; schools with neither -> ``missing_on_server``. Otherwise A3 puts
    each valid fragment in its column (a miss keeps the stored document;
    ``basic_info`` becomes ``{}``), A4 writes the manifest, G6 the summary,
    P17 the status. U5 applies it to every row of the school (all years).
    Only schools present in ``responses`` change, and of those not the ones
    whose primary document has null data (:func:`enrichment_rejects`). With
    several fetch rounds (``seq``) the latest round of an endpoint counts.
    """
    now = _as_of(as_of)
    names = [PRIMARY_ENDPOINT, PROBE_ENDPOINT, *FRAGMENT_ENDPOINTS]
    # One keyed aggregation resolves every endpoint of a school (A5); year,
    # documents and manifest are then expressions on that one row.
    w = resolve_attempts_wide(responses, "school_id", names, max_attempts=max_attempts)
    w = w.filter(~((F.coalesce(F.col(f"{PRIMARY_ENDPOINT}_code"), F.lit(404)) == 200)
                   & _null_data(variant(f"{PRIMARY_ENDPOINT}_body"))))
    p_code, q_code = F.col(f"{PRIMARY_ENDPOINT}_code"), F.col(f"{PROBE_ENDPOINT}_code")
    p_year = json_or(variant(f"{PRIMARY_ENDPOINT}_body"), "$.data.yearId", CURRENT_YEAR_ID)
    eff, missing_flag = effective_year(p_code, p_year, q_code, CURRENT_YEAR_ID, FALLBACK_YEAR_ID)
    docs = {"basic_info": F.when(p_code == 200, F.col(f"{PRIMARY_ENDPOINT}_body")).otherwise(F.lit("{}"))}
    for ep in FRAGMENT_ENDPOINTS:
        docs[ep] = F.when(F.col(f"{ep}_code") == 200, F.col(f"{ep}_body"))
    entries = sorted([("basic_info", F.lit(200))] + [(ep, F.col(f"{ep}_code")) for ep in FRAGMENT_ENDPOINTS])
    changes = w.select(
        "school_id", eff.alias("__eff"), missing_flag.alias("__missing"),
        *[d.alias(f"__doc_{FRAGMENT_COLUMNS[n]}") for n, d in docs.items()],
        manifest_of(entries).alias("__manifest"),
        F.col("profile_data_code").alias("__c_profile"), F.col("report_card_code").alias("__c_report"),
        F.lit(True).alias("__hit"))
    j = target.join(changes, "school_id", "left")
    hit = F.col("__hit").isNotNull()
    missing = hit & F.col("__missing")
    done = hit & ~F.col("__missing")
    # Merged documents and renamed old summaries in one projection (a
    # withColumn per column would re-analyse the wide plan each time).
    docs_merged = {col: F.when(done, F.coalesce(F.col(f"__doc_{col}"), F.col(col))).otherwise(F.col(col))
                   for col in FRAGMENT_COLUMNS.values()}
    merged = j.select(*[docs_merged.get(c, F.col(c)).alias(c) if c not in SUMMARY_COLUMNS
                        else F.col(c).alias(f"__old_{c}") for c in target.columns],
                      *[F.col(c) for c in j.columns if c.startswith("__") and not c.startswith("__doc_")])
    merged = extract_summary(merged, only_when=done)
    # A document with "data": null (or a null year) stops the school after
    # its fragments, manifest and year were stored, before the summary.
    ok = done & ~F.coalesce(F.col("summary_error"), F.lit(False)) & F.col("__eff").isNotNull()
    final = {c: F.when(ok, F.col(c)).otherwise(F.col(f"__old_{c}")) for c in SUMMARY_COLUMNS}
    final.update({
        "effective_year": F.when(done, F.col("__eff")).otherwise(F.col("effective_year")),
        "year_id": F.when(ok, F.col("__eff")).otherwise(F.col("year_id")),
        "enrichment_manifest": F.when(done, F.col("__manifest")).otherwise(F.col("enrichment_manifest")),
        "last_modified": F.when(done, now).otherwise(F.col("last_modified")),
        "scrape_status": (F.when(missing, F.lit("missing_on_server"))
                          .when(ok, completeness("__c_profile", "__c_report"))
                          .otherwise(F.col("scrape_status"))),
        "last_scraped_at": F.when(missing | ok, now).otherwise(F.col("last_scraped_at")),
    })
    dtypes = dict(target.dtypes)
    return merged.select(*[(final[c] if c in final else F.col(c)).cast(dtypes[c]).alias(c) for c in target.columns])


# The summary columns of the school table.
SUMMARY_COLUMNS = ("total_students", "total_boys", "total_girls", "total_teachers", "has_internet",
                   "has_library", "has_playground", "has_electricity", "lgd_urban_local_body_id",
                   "lgd_urban_local_body_name", "lgd_ward_id", "lgd_ward_name")


def enrich_state(target: DataFrame, responses: DataFrame, state: str | None, mode: str = "normal",
                 limit: int | None = None, as_of=None) -> tuple[DataFrame, DataFrame]:
    """G5 for one state's work queue (W4, or W5 with ``mode='recovery'``) -> ``(table, rejects)``.

    Only schools in the queue change; responses of others are left for a later run.
    """
    queue = work_queue(target, state, mode, limit).select("school_id").distinct()
    mine = responses.join(queue, "school_id", "left_semi")
    return school_enrichment(target, mine, as_of=as_of), enrichment_rejects(mine)


# ----------------------------------------------------------- G7 seeding

def seed_reference(target: DataFrame, seeds: DataFrame, key: str = "name", id_col: str = "id",
                   seq: str = "seq", as_of=None) -> DataFrame:
    """Insert seed rows whose key is absent; new rows get ids after MAX(id).

    Re-running with the same seeds changes nothing (idempotent).
    """
    s = seeds
    if "created_at" in target.columns and "created_at" not in s.columns:
        s = s.withColumn("created_at", _as_of(as_of))
    rows = s.select(*[c for c in s.columns if c in target.columns or c == seq])
    grown = insert_absent(target, rows, [key], seq=seq if seq in s.columns else None)
    return number_new_rows(grown, target, rows, key, id_col)


# ------------------------------------------------------ G8 config migration

def migrate_config(blueprints: DataFrame, field: str = "math_dependencies",
                   value_by_key: Mapping[str, list[str]] | None = None,
                   default: Sequence[str] = (), config_col: str = "sections_config",
                   where: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """G8 (U7 + P19): rewrite one field in every section of the default blueprint(s) -> ``(table, rejects)``.

    Every other field of a section stays, explicit nulls included. A
    configuration that is no JSON object (``config_not_object``) or holds an
    entry that is none (``entry_not_object``) is left as it is, whole, and
    listed in the rejects.
    """
    from civitas.operators.upsert import update_where
    cond = where if where is not None else F.coalesce(F.col("is_default"), F.lit(False))
    new = json_map_set(config_col, field, dict(value_by_key or {}), list(default))
    table = update_where(blueprints, cond, {config_col: F.coalesce(new, F.col(config_col))})
    reason = F.when(json_is_object(config_col), F.lit("entry_not_object")).otherwise(F.lit("config_not_object"))
    return table, blueprints.filter(cond & new.isNull()).withColumn("reasons", reason)


# ------------------------------------------------------------ G9 run loads

def run_loads(spark: SparkSession, steps: Mapping[str, Callable[[SparkSession, str], DataFrame]],
              paths: Mapping[str, str], selected: Sequence[str] | str = "all") -> dict[str, object]:
    """Run the selected loads (or all); a load whose input is missing is
    skipped with a message instead of failing the others."""
    names = list(steps) if selected == "all" else list(selected)
    out: dict[str, object] = {}
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in names:
        path = paths.get(name)
        if path is None:
            out[name] = f"skipped: no input configured for {name}"
            continue
        p = jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(conf).exists(p):
            out[name] = f"skipped: input {path} not found"
            continue
        out[name] = steps[name](spark, path)
    return out
