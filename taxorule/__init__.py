"""taxorule: keyword rule mining for product categorization on Spark.

The public API, one function per step of the job (all take and return DataFrames):
"""

from .config import DEFAULT_THRESHOLDS, Thresholds
from .operators.keywords import (keyword_occurrences, keyword_pairs, keyword_stats, keyword_totals,
                                 vendor_keyword_stats)
from .operators.reference import accepted_rules, rebuild_reference, reference_rule_counts, rule_changes
from .operators.scoring import (classify, pair_counts, pair_scores, role_records, rule_proposals,
                                score_pairs, score_rules, status_summary, strict_candidates)
from .operators.training import (category_counts, category_dim, extract_training, extraction_rejects,
                                 merge_stable, normalize_training, training_subset, usable_categories)
from .plans.pipeline import RunResult, import_files, run_vendor
from .session import build_session, cut_lineage
from .sources.json_io import (change_log_entry, latest_reference_file, read_reference_json, read_stable_json,
                              reference_entries, write_json_lines)
from .sources.match import match_products, read_match_documents, read_match_products
from .sources.store import SnapshotStore
from .streaming.vendor_drop import start_vendor_drop_stream

__all__ = [
    "DEFAULT_THRESHOLDS", "RunResult", "SnapshotStore", "Thresholds", "accepted_rules", "build_session",
    "category_counts", "category_dim", "change_log_entry", "classify", "cut_lineage", "extract_training", "extraction_rejects", "import_files",
    "keyword_occurrences", "keyword_pairs", "keyword_stats", "keyword_totals", "latest_reference_file",
    "match_products", "merge_stable", "normalize_training", "pair_counts", "pair_scores",
    "read_match_documents", "read_match_products", "read_reference_json", "read_stable_json",
    "rebuild_reference", "reference_entries", "reference_rule_counts", "role_records", "rule_changes",
    "rule_proposals", "run_vendor", "score_pairs", "score_rules", "start_vendor_drop_stream",
    "status_summary", "strict_candidates", "training_subset", "usable_categories",
    "vendor_keyword_stats", "write_json_lines",
]
