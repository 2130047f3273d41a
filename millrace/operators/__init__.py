from millrace.operators.asof import asof_join
from millrace.operators.assembly import (
    assemble,
    assemble_tagged,
    complete_ids,
    complete_tagged,
    fan_out_report,
    overdue_incomplete,
    presence,
)
from millrace.operators.keyed import dedup_latest, delete_matched, left_join_all, matched_count, upsert
from millrace.operators.metrics import (
    average_precision,
    best_of_grid,
    classification_metrics,
    optimal_threshold,
    prediction_summary,
    promotion_decisions,
    ranking_metrics,
    retrain_due,
    roc_auc,
    score_curve,
)
from millrace.operators.preprocessing import (
    category_table,
    class_weights,
    impute,
    impute_values,
    mode,
    ordinal_encode,
    scale_values,
    standardize,
)
from millrace.operators.quality import (
    check_conservation,
    check_not_null,
    check_split,
    check_subset,
    check_unique,
    rule_report,
    split_by_rules,
    tag_by_rules,
)
from millrace.operators.quantiles import exact_medians
from millrace.operators.sessions import session_features
from millrace.operators.training_set import (
    antileakage,
    cutoff_dates,
    label_coverage,
    labeled_only,
    split_column,
    split_summary,
    temporal_split,
    training_table,
)
from millrace.operators.windows import first_tick, late_report, late_rows, replay_windows, window_slice, with_empty_ticks

__all__ = [name for name in dir() if not name.startswith("_")]
