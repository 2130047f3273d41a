"""Small landing feeds for the clinical use case, written as files."""

from __future__ import annotations

import csv
import json
import os
import random
from datetime import datetime, timedelta

START = datetime(2024, 1, 1)


def stamp(value: datetime) -> str:
    return value.strftime("%Y-%m-%dT%H:%M:%SZ")


def clinical(pid, arrival, frail, rng, **changes):
    row = {
        "patient_id": pid,
        "snapshot_date": arrival.date().isoformat(),
        "updated_at": stamp(arrival),
        "age": rng.randint(75, 99) if frail else rng.randint(65, 85),
        "sex": rng.choice("MF"),
        "bmi": round(rng.uniform(18, 44), 1),
        "systolic_bp": rng.randint(95, 190),
        "diastolic_bp": rng.randint(56, 119),
        "gfr": round(rng.uniform(16, 119), 1),
        "albumin": round(rng.uniform(2.1, 5.4), 1),
        "hemoglobin": round(rng.uniform(8.1, 17.9), 1),
        "comorbidity_index": rng.randint(2, 10) if frail else rng.randint(0, 6),
        "polypharmacy": rng.randint(0, 15),
        "falls_last_12m": rng.randint(1, 4) if frail else rng.randint(0, 2),
        "hospitalizations_last_12m": rng.randint(0, 3),
        "mmse_score": rng.randint(0, 30),
        "depression_score": round(rng.uniform(0, 1), 2),
    }
    return {**row, **changes}


def sppb(pid, arrival, rng, **changes):
    row = {
        "response_id": f"S{pid}",
        "patient_id": pid,
        "survey_date": stamp(arrival),
        "sppb_balance": round(rng.uniform(0, 4), 1),
        "sppb_gait_speed_s": round(rng.uniform(1, 15), 1),
        "sppb_chair_stand_s": round(rng.uniform(5, 60), 1),
        "sppb_total": rng.randint(0, 12),
    }
    return {**row, **changes}


def lifestyle(pid, arrival, rng, **changes):
    row = {
        "response_id": f"L{pid}",
        "patient_id": pid,
        "survey_date": stamp(arrival),
        "steps_per_day": rng.randint(0, 20000),
        "moderate_exercise_min_week": rng.randint(0, 600),
        "protein_intake_g_per_kg": round(rng.uniform(0.3, 2.0), 2),
        "social_contacts_per_week": rng.randint(0, 10),
        "tobacco_use": rng.randint(0, 2),
        "alcohol_units_per_week": rng.randint(0, 3),
    }
    return {**row, **changes}


def gait(pid, arrival, rng, n=5):
    return [
        {
            "event_id": f"G{pid}-{i}",
            "patient_id": pid,
            "session_id": f"W{pid}",
            "session_timestamp": stamp(arrival + timedelta(seconds=2 * i)),
            "stride_length_m": round(rng.uniform(0.2, 1.2), 3),
            "stride_time_s": round(rng.uniform(0.5, 2.5), 3),
            "cadence_steps_min": round(rng.uniform(40, 150), 1),
            "gait_speed_m_s": round(rng.uniform(0.1, 2.0), 3),
            "asymmetry_index": round(rng.uniform(0, 0.5), 3),
            "double_support_pct": round(rng.uniform(10, 60), 1),
        }
        for i in range(n)
    ]


def label(pid, arrival, frail, **changes):
    row = {
        "patient_id": pid,
        "snapshot_date": arrival.date().isoformat(),
        "label_available_date": (arrival + timedelta(days=2)).date().isoformat(),
        "frailty_label": int(frail),
        "updated_at": stamp(arrival + timedelta(hours=2)),
    }
    return {**row, **changes}


def write_csv(root, feed, name, rows):
    path = os.path.join(root, feed, "2024")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", newline="") as f:
        writer = csv.DictWriter(f, rows[0].keys())
        writer.writeheader()
        writer.writerows(rows)


def write_json(root, feed, name, rows):
    path = os.path.join(root, feed, "2024")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.writelines(json.dumps(row) + "\n" for row in rows)


def write_feeds(root, n=60, step=timedelta(hours=3), without=None, seed=1, first=0):
    """``n`` patients, one every ``step``; ``without`` maps a feed to the patients that it lacks."""
    rng = random.Random(seed)
    lacking = {k: set(v) for k, v in (without or {}).items()}
    rows = {k: [] for k in ("clinical", "sppb", "lifestyle", "gait", "labels")}
    for i in range(first, first + n):
        pid, at, frail = f"P{i:04d}", START + step * (i + 1), rng.random() < 0.4
        made = {
            "clinical": [clinical(pid, at, frail, rng)],
            "sppb": [sppb(pid, at, rng)],
            "lifestyle": [lifestyle(pid, at, rng)],
            "gait": gait(pid, at, rng),
            "labels": [label(pid, at, frail)],
        }
        for feed, new in made.items():
            if i not in lacking.get(feed, ()):
                rows[feed] += new
    for feed, new in rows.items():
        if new:
            write = write_csv if feed in ("clinical", "labels") else write_json
            write(root, feed, f"batch_{seed}_{first}." + ("csv" if write is write_csv else "json"), new)
    return rows
