"""Table schemas of the registry (DDL strings, parsed by Spark).

Fixed values: column names and types of the registry tables, kept as the
source schemas declare them. The school table is the flattened year-12
layout plus the columns the enrichment writes (effective_year,
enrichment_manifest, the urban-body and ward ids and names). Identifier
columns are BIGINT (a superset of the source's INTEGER) so that keys past
2^31 neither overflow an ANSI cast nor get rejected.
"""

from __future__ import annotations

from pyspark.sql import types as T

LGD_MASTER = (
    "id int, village_code string, village_name string, subdistrict_code string, "
    "subdistrict_name string, district_code string, district_name string, state_code string, "
    "state_name string, pincode string, last_updated timestamp_ntz"
)

SYNC_STATUS = "job_name string, last_offset bigint, last_updated timestamp_ntz"

DISTRICT_DEMOGRAPHICS = (
    "state_name string, district_name string, year_code string, total_population int, "
    "sc_population int, st_population int, general_population int, source_file string, "
    "created_at timestamp_ntz"
)

SCHOOLS = (
    "school_id bigint, year_id int, udise_code string, school_name string, school_status int, "
    "status_name string, last_modified timestamp_ntz, "
    "state_id bigint, state_cd string, state_name string, district_id bigint, district_cd string, "
    "district_name string, block_id bigint, block_cd string, block_name string, cluster_id bigint, "
    "cluster_cd string, cluster_name string, village_id bigint, vill_ward_cd string, village_name string, "
    "pincode int, address string, email string, "
    "lgd_state_id int, lgd_district_id int, lgd_block_id int, lgd_village_id string, lgd_vill_name string, "
    "lgd_panchayat_id string, lgd_vill_panchayat_name string, "
    "sch_loc_rural_urban int, sch_loc_desc string, sch_category_id int, sch_cat_desc string, "
    "sch_type int, sch_type_desc string, sch_mgmt_id int, sch_mgmt_desc string, "
    "sch_mgmt_parent_id int, sch_mgmt_desc_st string, sch_broad_mgmt_id int, class_frm int, class_to int, "
    "is_operational_2018_to_19 int, is_operational_2019_to_20 int, is_operational_2020_to_21 int, "
    "is_operational_2021_to_22 int, is_operational_2022_to_23 int, "
    "total_students int, total_boys int, total_girls int, total_teachers int, "
    "has_internet boolean, has_library boolean, has_playground boolean, has_electricity boolean, "
    "scrape_status string, error_message string, last_scraped_at timestamp_ntz, "
    "basic_info string, report_card string, facility_data string, profile_data string, "
    "enrollment_social string, enrollment_religion string, enrollment_mainstreamed string, "
    "enrollment_ews string, enrollment_rte string, "
    "effective_year int, enrichment_manifest string, "
    "lgd_urban_local_body_id string, lgd_urban_local_body_name string, lgd_ward_id string, lgd_ward_name string"
)

# Endpoint -> school-table column for the nine fragments.
FRAGMENT_COLUMNS = {
    "basic_info": "basic_info",
    "report_card": "report_card",
    "facility_data": "facility_data",
    "profile_data": "profile_data",
    "social_1": "enrollment_social",
    "social_2": "enrollment_religion",
    "social_3": "enrollment_mainstreamed",
    "social_4": "enrollment_ews",
    "social_5": "enrollment_rte",
}

# The nine proposal statuses a CHECK allows.
PROPOSAL_STATUSES = ("draft", "in_progress", "archived", "completed", "under_review", "rejected",
                     "approved", "ready_to_publish", "published")


def struct(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)
