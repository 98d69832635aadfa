"""Plain row-by-row forms of the rules, for comparison on random rows."""

from __future__ import annotations

import math


def _less(value, limit):
    return value is not None and not math.isnan(value) and value < limit


def _more(value, limit):
    return value is not None and not math.isnan(value) and value > limit


def screening_score(row: dict) -> float:
    out = row["provider_network_status"] == "Out-of-Network"
    dx, px = row["primary_diagnosis_code"] or "", row["procedure_code"] or ""
    accuracy = 0.95
    if "pediatric" in dx.lower() and _more(row["patient_age"], 18):
        accuracy -= 0.2
    if row["patient_gender"] == "M" and ("pregnancy" in dx or "obstetric" in dx):
        accuracy -= 0.3
    if len(dx) < 3 or len(px) < 3:
        accuracy -= 0.1
    document = row["documentation_quality_score"]
    weight = 0.9 - 0.1 if _more(row["billed_amount"], 5000) else 0.9
    need = None if document is None else weight * document
    zscore = row["billed_amount_zscore"]
    odd = _more(None if zscore is None else abs(zscore), 2.0) or _more(row["billed_amount"], 20000)
    steps = [
        (out, 0.3),
        (_less(document, 0.8), 0.25),
        (max(0.5, accuracy) < 0.9, 0.2),
        (_less(need, 0.8), 0.25),
        (odd, 0.15),
        (_more(row["days_to_submission"], 60), 0.1),
        (_more(row["patient_rejection_rate"], 0.2), 0.1),
        (_more(row["provider_specialty_risk"], 0.25), 0.1),
    ]
    score = 1.0
    for fired, delta in steps:
        if fired:
            score -= delta
    return max(0.0, score)


def decision_probability(row: dict) -> float:
    steps = [
        (_more(row["coding_accuracy_score"], 0.95), 0.1),
        (_less(row["coding_accuracy_score"], 0.85), -0.2),
        (_less(row["provider_data_completeness"], 0.7), -0.15),
        (bool(row["prior_authorization_obtained"]), 0.08),
        (bool(row["eligibility_verification_completed"]), 0.05),
        (row["network_status"] == "Out-of-Network", -0.25),
        (_more(row["billed_amount"], 5000), -0.05),
        (_more(row["days_service_to_submission"], 60), -0.1),
    ]
    p = 0.8
    for fired, delta in steps:
        if fired:
            p += delta
    return max(0.1, min(0.98, p))
