"""Typed record layouts shared by sources, operators and sinks."""

from __future__ import annotations

STRING_FIELDS = (
    "pim_category_id", "pim_category_name", "pim_category_path",
    "vendor_short_name", "vendor_category_id", "vendor_category_name", "vendor_category_path",
    "article_id", "description_short",
)

# Training record (stable dataset row). The two *_falsy flags remember a JSON id whose
# Python truthiness was False (numeric 0, false, [], {}), which keys / filters treat as
# missing although str() of it is not blank.
TRAINING_COLUMNS = STRING_FIELDS + ("keywords", "class_codes", "ordinal",
                                    "article_id_falsy", "pim_category_id_falsy")

TRAINING_DDL = ", ".join(
    [f"{c} string" for c in STRING_FIELDS]
    + ["keywords array<string>",
       "class_codes array<struct<system:string,code:string>>",
       "ordinal bigint", "article_id_falsy boolean", "pim_category_id_falsy boolean"])

# Flat vendor match products: one row per (vendor category, PIM match, product).
PRODUCT_COLUMNS = TRAINING_COLUMNS + ("assignment_source", "vcat_pos", "match_pos", "product_pos")

COUNT_COLUMNS = ("inside_count", "train_total_count", "hard_outside_count",
                 "vendor_inside_count", "vendor_total_count", "vendor_outside_count")

SCORED_COLUMNS = ("pim_category_id", "keyword") + COUNT_COLUMNS + (
    "known_in_previous_training", "has_vendor_usage", "global_candidate",
    "vendor_supports", "vendor_violates", "is_new_rule", "vendor_status")

# Mapping reference, kept flat: one row per category, one row per (category, rule).
REFERENCE_CATEGORY_DDL = ("cat_key string, pim_category_id string, pim_category_name string, "
                          "pim_category_path string, vendor_mappings string, entry_json string, "
                          "position bigint")
REFERENCE_RULE_DDL = ("cat_key string, entry_position bigint, rule_position bigint, field_name string, operator string, "
                      "values_include array<string>, values_exclude array<string>, "
                      "rule_json string")
