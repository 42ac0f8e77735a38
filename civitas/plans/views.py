"""Named read views (V1-V7).

Each view is a function ``DataFrame -> DataFrame``; Catalyst expands it
into the caller's plan, so the state gate (P3) is pushed into the Parquet
scan and only the referenced columns are read. ``facility_data`` is parsed
once per row for all fields of a view (one ``from_json``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.functions.cleaning import composite_key
from civitas.functions.json import json_struct, text_flag, text_to_int
from civitas.operators.joins import best_match_left


def _facility(df: DataFrame, ints: dict[str, str], flags: dict[str, str],
              texts: dict[str, str] | None = None, doc: str = "facility_data", on_bad: str = "fail"):
    """Columns for JSON fields under ``data``: integers, ``= 1`` flags, raw texts."""
    texts = texts or {}
    keys = list(dict.fromkeys([*ints.values(), *flags.values(), *texts.values()]))
    parsed = json_struct(doc, [f"data.{k}" for k in keys]).getField("data")
    cols = {}
    for out, k in texts.items():
        cols[out] = parsed.getField(k)
    for out, k in ints.items():
        cols[out] = text_to_int(parsed.getField(k), on_bad)
    for out, k in flags.items():
        cols[out] = text_flag(parsed.getField(k), on_bad)
    return cols


def view_student_population(schools: DataFrame) -> DataFrame:
    """V1: thin overview of enrolment, gated on state."""
    return schools.filter(F.col("state_name").isNotNull()).select(
        "udise_code", "school_name", F.col("state_name").alias("state"),
        F.col("district_name").alias("district"), F.col("block_name").alias("block"),
        F.col("cluster_name").alias("cluster"), "total_students", "total_boys", "total_girls", "year_id")


def view_campus_assets(schools: DataFrame, on_bad: str = "fail") -> DataFrame:
    """V2: building, boundary and campus flags.

    Like the ``::INTEGER`` casts they mirror, a malformed number (``'1.0'``,
    ``'abc'``) fails the query; ``on_bad='null'`` reads it as NULL instead
    (applies to V2-V5).
    """
    c = _facility(schools,
                  ints={"building_blocks": "bldBlkTot"},
                  flags={"has_playground": "playgroundYn", "has_ramps": "rampsYn",
                         "has_handrails": "handrailsYn", "has_solar_power": "solarpanelYn",
                         "has_rain_harvesting": "rainHarvestYn"},
                  texts={"building_status": "bldStatus", "boundary_wall_type": "bndrywallType"}, on_bad=on_bad)
    order = ["building_status", "building_blocks", "boundary_wall_type", "has_playground", "has_ramps",
             "has_handrails", "has_solar_power", "has_rain_harvesting"]
    return schools.filter(F.col("state_name").isNotNull()).select(
        "udise_code", "school_name", "state_name", *[c[k].alias(k) for k in order])


def view_classroom_condition(schools: DataFrame, on_bad: str = "fail") -> DataFrame:
    """V3: classroom counts by condition and a furniture flag."""
    c = _facility(schools,
                  ints={"total_classrooms": "clsrmsInst", "rooms_good": "clsrmsGd",
                        "rooms_minor_repair": "clsrmsMin", "rooms_major_repair": "clsrmsMaj",
                        "rooms_pucca_good": "clsrmsGdPpu"},
                  flags={"has_furniture": "stusHvFurnt"}, on_bad=on_bad)
    order = ["total_classrooms", "rooms_good", "rooms_minor_repair", "rooms_major_repair",
             "rooms_pucca_good", "has_furniture"]
    return schools.filter(F.col("state_name").isNotNull()).select(
        "udise_code", "school_name", *[c[k].alias(k) for k in order])


def view_digital_infrastructure(schools: DataFrame, on_bad: str = "fail") -> DataFrame:
    """V4: internet and ICT flags, device counts."""
    c = _facility(schools,
                  ints={"laptop_count": "laptopTot", "desktop_count": "desktopFun",
                        "projector_count": "projectorTot", "printer_count": "printerTot"},
                  flags={"has_internet": "internetYn", "has_ict_lab": "ictLabYn"}, on_bad=on_bad)
    order = ["has_internet", "has_ict_lab", "laptop_count", "desktop_count", "projector_count",
             "printer_count"]
    return schools.filter(F.col("state_name").isNotNull()).select(
        "udise_code", "school_name", *[c[k].alias(k) for k in order])


def view_specialized_spaces(schools: DataFrame, on_bad: str = "fail") -> DataFrame:
    """V5: principal room, library, tinkering lab flags and other rooms."""
    c = _facility(schools,
                  ints={"staff_and_store_rooms_count": "othrooms"},
                  flags={"has_principal_room": "hmRoomYn", "has_library": "libraryYn",
                         "has_atal_tinkering_lab": "tinkeringLabYn"}, on_bad=on_bad)
    order = ["has_principal_room", "has_library", "has_atal_tinkering_lab", "staff_and_store_rooms_count"]
    return schools.filter(F.col("state_name").isNotNull()).select(
        "udise_code", "school_name", *[c[k].alias(k) for k in order])


def view_village_discovery(master: DataFrame, demographics: DataFrame) -> DataFrame:
    """V6: master LEFT JOIN demographics, best (largest population) match per village."""
    d = demographics.select(F.col("lgd_code"), F.col("total_population").alias("population"),
                            F.col("households"))
    best = best_match_left(master, d, "village_code", "lgd_code",
                           [F.col("population").desc_nulls_last(), F.col("households").desc_nulls_last()])
    return best.select(F.col("village_code").alias("lgd_code"), F.col("village_name").alias("village"),
                       F.col("subdistrict_name").alias("taluk"), F.col("district_name").alias("district"),
                       F.col("state_name").alias("state"), "pincode", "population", "households")


# Raw amenity column -> view column (12 of the raw table's
# columns; numbers stay text as in the raw table).
AMENITY_VIEW_COLUMNS = {
    "state": "state",
    "district": "district",
    "sub_district": "sub_district",
    "ulb_rlb_village": "village",
    "total_geographical_area_covered_by_village": "area_ha",
    "number_of_village_households": "households",
    "name_of_the_nearest_statutory_town": "nearest_town_name",
    "distance_between_village_and_nearest_statutory_town": "distance_to_nearest_town_km",
    "name_of_the_district_head_quarter_of_village": "district_hq_name",
    "distance_between_the_village_and_district_head_quarter": "distance_to_district_hq_km",
    "name_of_the_subdistrict_head_quarter_of_village": "taluk_hq_name",
    "distance_between_village_and_sub_district_head_quarter": "distance_to_taluk_hq_km",
}


def view_village_amenities(raw: DataFrame) -> DataFrame:
    """V7: 12 raw columns renamed plus a NULL-propagating composite key."""
    cols = [F.col(src).alias(dst) for src, dst in AMENITY_VIEW_COLUMNS.items()]
    key = composite_key("state", "district", "sub_district", "ulb_rlb_village").alias("composite_key")
    return raw.select(*cols[:4], key, *cols[4:])
