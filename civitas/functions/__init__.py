"""Column expressions: cleaning (P1-P3, P8-P12, P15, P17, P18, P22) and JSON."""

from civitas.functions.cleaning import (  # noqa: F401
    NUMERIC_TEXT, clean_int, completeness, composite_key, lookup_code, na,
    priority_position, project, row_sum, slug, total_or_parts, unmask_code,
    where_present, with_defaults,
)
from civitas.functions.json import (  # noqa: F401
    classify_response, initial_status, json_flag, json_int,
    json_map_set, json_or, json_struct, json_text, profile_fields, strict_flag,
    text_flag, text_to_int, truthy_text, variant, vget,
)
