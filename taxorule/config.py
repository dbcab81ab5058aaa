"""Run parameters and the fixed business values of the rule-mining job."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    """Thresholds of the category / keyword rule tests (defaults = the job's constants)."""

    min_products: int = 10          # products a category needs to enter training (>=)
    min_inside: int = 10            # keyword occurrences inside the category (>=)
    max_hard_outside: int = 0       # occurrences in other categories (<=)
    min_vendor_inside: int = 3      # vendor occurrences inside the category (>=)
    max_vendor_outside: int = 0     # vendor occurrences outside the category (<=)


DEFAULT_THRESHOLDS = Thresholds()

# ---- Fixed values: these must equal the original job's values for equal results ----
TRUSTED_SOURCE = "existing_category_match"
STATUS_NEW = "new"
STATUS_SUPPORTED = "supported"
STATUS_VIOLATED = "violated"
STATUS_NOT_IMPACTED = "not_impacted"
ACCEPTED_STATUSES = (STATUS_NEW, STATUS_SUPPORTED, STATUS_NOT_IMPACTED)
RULE_FIELD_NAME = "KEYWORD"
RULE_OPERATOR = "contains_any"
MATCH_FILE_SUFFIX = "_categoryMatchingProposals_oneVendor_to_onePim_match.json"
RUN_TS_PATTERN = r"^\d{8}-\d{6}$"
# -------------------------------------------------------------------------------------
