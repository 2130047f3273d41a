"""The health-risk use case: five feeds, their quality rules, and the roles of their columns."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from millrace.functions.rules import RuleBook
from millrace.sources.landing import SourceSpec

ENTITY = "patient_id"
OBSERVED = "snapshot_date"
AVAILABLE = "label_available_date"
LABEL = "frailty_label"
PROBABILITY, PREDICTION = "frailty_prob", "frailty_pred"
ARRIVAL = "sim_arrival_date"
WAIT_DAYS = 3

# Feed columns, their types, keys and watermark columns.
CLINICAL = SourceSpec(
    name="clinical",
    format="csv",
    types={
        "patient_id": "STRING",
        "snapshot_date": "DATE",
        "updated_at": "TIMESTAMP",
        "age": "INT",
        "sex": "STRING",
        "bmi": "DOUBLE",
        "systolic_bp": "INT",
        "diastolic_bp": "INT",
        "gfr": "DOUBLE",
        "albumin": "DOUBLE",
        "hemoglobin": "DOUBLE",
        "comorbidity_index": "INT",
        "polypharmacy": "INT",
        "falls_last_12m": "INT",
        "hospitalizations_last_12m": "INT",
        "mmse_score": "INT",
        "depression_score": "DOUBLE",
    },
    keys=("patient_id", "snapshot_date"),
    ts_col="updated_at",
)
SPPB = SourceSpec(
    name="sppb",
    format="json",
    types={
        "response_id": "STRING",
        "patient_id": "STRING",
        "survey_date": "TIMESTAMP",
        "sppb_balance": "DOUBLE",
        "sppb_gait_speed_s": "DOUBLE",
        "sppb_chair_stand_s": "DOUBLE",
        "sppb_total": "INT",
    },
    keys=("response_id",),
    ts_col="survey_date",
)
LIFESTYLE = SourceSpec(
    name="lifestyle",
    format="json",
    types={
        "response_id": "STRING",
        "patient_id": "STRING",
        "survey_date": "TIMESTAMP",
        "steps_per_day": "INT",
        "moderate_exercise_min_week": "INT",
        "protein_intake_g_per_kg": "DOUBLE",
        "social_contacts_per_week": "INT",
        "tobacco_use": "INT",
        "alcohol_units_per_week": "INT",
    },
    keys=("response_id",),
    ts_col="survey_date",
)
GAIT = SourceSpec(
    name="gait",
    format="json",
    types={
        "event_id": "STRING",
        "patient_id": "STRING",
        "session_id": "STRING",
        "session_timestamp": "TIMESTAMP",
        "stride_length_m": "DOUBLE",
        "stride_time_s": "DOUBLE",
        "cadence_steps_min": "DOUBLE",
        "gait_speed_m_s": "DOUBLE",
        "asymmetry_index": "DOUBLE",
        "double_support_pct": "DOUBLE",
    },
    keys=("event_id",),
    ts_col="session_timestamp",
    window=timedelta(minutes=120),
)
LABELS = SourceSpec(
    name="labels",
    format="csv",
    types={
        "patient_id": "STRING",
        "snapshot_date": "DATE",
        "label_available_date": "DATE",
        "frailty_label": "INT",
        "updated_at": "TIMESTAMP",
    },
    keys=("patient_id", "snapshot_date"),
    ts_col="updated_at",
)
SOURCES: dict[str, SourceSpec] = {s.name: s for s in (CLINICAL, SPPB, LIFESTYLE, GAIT, LABELS)}

# The rules of every feed, name and SQL.
RULE_SQL = {
    "clinical": {
        "valid_patient_id": "patient_id IS NOT NULL",
        "valid_snapshot_date": "snapshot_date IS NOT NULL",
        "valid_age": "age BETWEEN 65 AND 100",
        "valid_sex": "sex IN ('M', 'F')",
        "valid_bmi": "bmi BETWEEN 17.0 AND 45.0",
        "valid_systolic_bp": "systolic_bp BETWEEN 90 AND 200",
        "valid_diastolic_bp": "diastolic_bp BETWEEN 55 AND 120",
        "valid_gfr": "gfr BETWEEN 15.0 AND 120.0",
        "valid_albumin": "albumin BETWEEN 2.0 AND 5.5",
        "valid_hemoglobin": "hemoglobin BETWEEN 8.0 AND 18.0",
        "valid_comorbidity_index": "comorbidity_index BETWEEN 0 AND 10",
        "valid_polypharmacy": "polypharmacy BETWEEN 0 AND 15",
        "valid_falls_last_12m": "falls_last_12m BETWEEN 0 AND 4",
        "valid_hospitalizations": "hospitalizations_last_12m BETWEEN 0 AND 3",
        "valid_mmse_score": "mmse_score BETWEEN 0 AND 30",
        "valid_depression_score": "depression_score BETWEEN 0.0 AND 1.0",
    },
    "sppb": {
        "valid_response_id": "response_id IS NOT NULL",
        "valid_patient_id_sppb": "patient_id IS NOT NULL",
        "valid_survey_date_sppb": "survey_date IS NOT NULL",
        "valid_sppb_balance": "sppb_balance BETWEEN 0.0 AND 4.0",
        "valid_sppb_gait_speed_s": "sppb_gait_speed_s BETWEEN 1.0 AND 15.0",
        "valid_sppb_chair_stand_s": "sppb_chair_stand_s BETWEEN 5.0 AND 60.0",
        "valid_sppb_total": "sppb_total BETWEEN 0 AND 12",
    },
    "lifestyle": {
        "valid_response_id_ls": "response_id IS NOT NULL",
        "valid_patient_id_ls": "patient_id IS NOT NULL",
        "valid_steps_per_day": "steps_per_day BETWEEN 0 AND 20000",
        "valid_moderate_exercise": "moderate_exercise_min_week BETWEEN 0 AND 600",
        "valid_protein_intake": "protein_intake_g_per_kg BETWEEN 0.3 AND 2.0",
        "valid_social_contacts": "social_contacts_per_week BETWEEN 0 AND 10",
        "valid_tobacco_use": "tobacco_use IN (0, 1, 2)",
        "valid_alcohol_units": "alcohol_units_per_week IN (0, 1, 2, 3)",
    },
    "gait": {
        "valid_event_id": "event_id IS NOT NULL",
        "valid_patient_id_gait": "patient_id IS NOT NULL",
        "valid_session_id": "session_id IS NOT NULL",
        "valid_session_timestamp": "session_timestamp IS NOT NULL",
        "valid_stride_length": "stride_length_m BETWEEN 0.2 AND 1.2",
        "valid_stride_time": "stride_time_s BETWEEN 0.5 AND 2.5",
        "valid_cadence": "cadence_steps_min BETWEEN 40.0 AND 150.0",
        "valid_gait_speed": "gait_speed_m_s BETWEEN 0.1 AND 2.0",
        "valid_asymmetry_index": "asymmetry_index BETWEEN 0.0 AND 0.5",
        "valid_double_support_pct": "double_support_pct BETWEEN 10.0 AND 60.0",
    },
    "labels": {
        "valid_patient_id_lbl": "patient_id IS NOT NULL",
        "valid_snapshot_date_lbl": "snapshot_date IS NOT NULL",
        "valid_label_available_date": "label_available_date IS NOT NULL",
        "valid_frailty_label_lbl": "frailty_label IN (0, 1)",
        "temporal_coherence": "label_available_date > snapshot_date",
    },
}


def rule_book(rules: Mapping = RULE_SQL) -> RuleBook:
    """All rules of the feeds."""
    book = RuleBook()
    for tag, named in rules.items():
        book.add_all(tag, named)
    return book


RULES = rule_book()

# Outputs of the gait session features and the measurement each one comes from.
SESSION_KEY = ("patient_id", "session_id")
SESSION_MEANS = {
    "gait_velocity_ms": "gait_speed_m_s",
    "stride_length_m": "stride_length_m",
    "stride_time_s": "stride_time_s",
    "cadence_steps_min": "cadence_steps_min",
    "asymmetry_index": "asymmetry_index",
    "double_support_pct": "double_support_pct",
}
SESSION_VARIATIONS = {"stride_time_cv": "stride_time_s"}
SESSION_COUNT = "n_strides"

# Columns that a side source does not hand over to a wide row.
AUDIT = frozenset({"ingestion_timestamp", "source_file", "sim_arrival_date", "updated_at", "year", "month"})
SIDE_HIDDEN = AUDIT | {"session_id", "session_date", "response_id", "survey_date"}

# Columns of a wide row that are never model inputs, and those whose presence would leak the outcome.
NOT_FEATURES = AUDIT | {
    "patient_id",
    "snapshot_date",
    "label_available_date",
    "frailty_label",
    "session_id",
    "session_date",
    "assembly_timestamp",
}
FORBIDDEN = ("sim_arrival_date", "label_available_date", "frailty_label")
