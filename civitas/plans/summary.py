"""Summary extraction from stored fragments.

Twelve summary columns from four JSON documents, with the sentinel rules:
counts default to -1 (unknown, not zero), flags to false, urban ids to
NULL when the document is absent. Each document is parsed once (Variant,
because flags compare JSON *values*: 1 and 1.0 and true count, "1" does not).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civitas.functions.cleaning import total_or_parts
from civitas.functions.json import strict_flag, variant


def extract_summary(df: DataFrame, social: str = "enrollment_social", report: str = "report_card",
                    facility: str = "facility_data", profile: str = "profile_data",
                    only_when: Column | None = None) -> DataFrame:
    """Add the 12 summary columns and ``summary_error``: what the
    row-at-a-time extractor could not read -- a document whose ``data`` is
    null, a null total object, a count that is present but no integer.

    ``only_when`` limits the parsing to the rows that need a new summary
    (e.g. the schools of this enrichment batch inside the whole table);
    other rows get default summary columns and must keep their stored values.
    """
    def data_of(c: str) -> Column:
        v = F.variant_get(variant(c), "$.data", "variant")
        return v if only_when is None else F.when(only_when, v)

    # Each document is parsed once and its "data" object kept as a Variant
    # column; every field below reads relative to it. A document counts when
    # it holds a "data" key (SQL NULL = absent; a JSON null is a variant null).
    df = df.withColumns({"__ds": data_of(social), "__dr": data_of(report),
                         "__df": data_of(facility), "__dp": data_of(profile)})
    df = df.withColumn("__dst", F.variant_get(F.col("__ds"), "$.schEnrollmentYearDataTotal", "variant"))
    s, r, f, p = F.col("__ds"), F.col("__dr"), F.col("__df"), F.col("__dp")
    sp, rp, fp, pp = s.isNotNull(), r.isNotNull(), f.isNotNull(), p.isNotNull()

    def int_or(v: Column, path: str) -> Column:
        return F.coalesce(F.try_variant_get(v, path, "int"), F.lit(-1))

    st = F.col("__dst")
    b, g, t = int_or(st, "$.rowBoyTotal"), int_or(st, "$.rowGirlTotal"), int_or(st, "$.rowTotal")
    students = total_or_parts(t, b, g, stated_sentinel_falls_back=True)
    mt, ft = int_or(r, "$.totMale"), int_or(r, "$.totFemale")
    teachers = total_or_parts(F.try_variant_get(r, "$.totalTeacher", "int"), mt, ft, stated_sentinel_falls_back=False)

    def when_present(present: Column, value: Column, default) -> Column:
        return F.when(present, value).otherwise(F.lit(default))

    def data_null(v: Column) -> Column:
        return F.coalesce(v.isNotNull() & F.is_variant_null(v), F.lit(False))

    def bad_count(v: Column, path: str) -> Column:
        x = F.variant_get(v, path, "variant")
        return F.coalesce(x.isNotNull() & ~F.is_variant_null(x)
                          & ((F.schema_of_variant(x) == F.lit("STRING")) | F.try_variant_get(x, "$", "int").isNull()), F.lit(False))

    bad_counts = data_null(st)
    for v, path in ((st, "$.rowBoyTotal"), (st, "$.rowGirlTotal"), (st, "$.rowTotal"),
                    (r, "$.totMale"), (r, "$.totFemale"), (r, "$.totalTeacher")):
        bad_counts = bad_counts | bad_count(v, path)

    cols = {
        "total_students": when_present(sp, students, -1).cast("int"),
        "total_boys": when_present(sp, b, -1).cast("int"),
        "total_girls": when_present(sp, g, -1).cast("int"),
        "total_teachers": when_present(rp, teachers, -1).cast("int"),
        "has_internet": when_present(fp, strict_flag(f, "$.internetYn"), False),
        "has_library": when_present(fp, strict_flag(f, "$.libraryYn"), False),
        "has_playground": when_present(fp, strict_flag(f, "$.playgroundYn"), False),
        "has_electricity": when_present(fp, strict_flag(f, "$.electricityYn"), False),
        "lgd_urban_local_body_id": F.when(pp, F.try_variant_get(p, "$.lgdurbanlocalbodyId", "string")),
        "lgd_urban_local_body_name": F.when(pp, F.try_variant_get(p, "$.lgdurbanlocalbodyName", "string")),
        "lgd_ward_id": F.when(pp, F.try_variant_get(p, "$.lgdwardId", "string")),
        "lgd_ward_name": F.when(pp, F.try_variant_get(p, "$.lgdwardName", "string")),
        "summary_error": data_null(s) | data_null(r) | data_null(f) | data_null(p) | bad_counts,
    }
    # one projection (withColumns), not one re-analysed plan per column
    return df.withColumns(cols).drop("__ds", "__dr", "__df", "__dp", "__dst")
