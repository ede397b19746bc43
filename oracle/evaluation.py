from .history import label_ctes

PREDS = f"""
{label_ctes()},
scored AS (
  SELECT l.machine_id, l.timestamp, model, failure_label AS label, time_to_failure_hours,
         least(0.99::DOUBLE, 0.05::DOUBLE + 0.4::DOUBLE * failure_label
               + ((t.event_id * step) % 1000) / 1600.0::DOUBLE) AS probability
  FROM labels l JOIN pdm_telemetry t ON t.machineID = l.machine_id AND t.datetime = l.timestamp,
       (VALUES ('A', 7919), ('B', 104729)) AS m(model, step)
),
preds AS (SELECT *, CAST(probability >= 0.5 AS INTEGER) AS prediction FROM scored)
"""
CM = (
    PREDS
    + """,
cm AS (
  SELECT model, sum(label * prediction)::DOUBLE AS tp, sum((1 - label) * prediction)::DOUBLE AS fp,
         sum(label * (1 - prediction))::DOUBLE AS fn, sum((1 - label) * (1 - prediction))::DOUBLE AS tn
  FROM preds GROUP BY model
)
"""
)


def _div(a, b):
    return f"CASE WHEN {b} = 0 THEN 0 ELSE ({a}) / ({b}) END"


RATES = {
    "accuracy": "(tp + tn) / (tp + tn + fp + fn)",
    "precision": _div("tp", "(tp + fp)"),
    "recall": _div("tp", "(tp + fn)"),
    "specificity": _div("tn", "(tn + fp)"),
    "f1_score": _div("2 * tp", "(2 * tp + fp + fn)"),
    "mcc": _div(
        "tp * tn - fp * fn", "sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))"
    ),
    "fpr": _div("fp", "(fp + tn)"),
    "fnr": _div("fn", "(fn + tp)"),
}


def _rates(*names):
    return ", ".join(f"{RATES[n]} AS {n}" for n in names)


# area under ROC as the share of (positive, negative) pairs in the right order
RANKS = """,
r AS (SELECT *, rank() OVER (PARTITION BY model ORDER BY probability)
               + (count(*) OVER (PARTITION BY model, probability) - 1) / 2.0::DOUBLE AS mid FROM preds),
auc AS (
  SELECT model, (sum(mid) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2.0::DOUBLE)
                / (sum(label)::DOUBLE * sum(1 - label)) AS roc_auc
  FROM r GROUP BY model
),
pr AS (
  SELECT model, probability, sum(sum(label)) OVER w AS ctp, sum(sum(1 - label)) OVER w AS cfp,
         sum(label) AS pos, sum(sum(label)) OVER (PARTITION BY model) AS p,
         sum(sum(1 - label)) OVER (PARTITION BY model) AS n
  FROM preds GROUP BY model, probability WINDOW w AS (PARTITION BY model ORDER BY probability DESC)
),
ap AS (SELECT model, sum(pos / p::DOUBLE * ctp / (ctp + cfp)) AS avg_precision FROM pr GROUP BY model)
"""
COST = "fp * 500 + fn * 12000 + tp * 500"


def _thresholds(first: float, count: int) -> str:
    rows = ", ".join(f"({first + 0.05 * i!r}::DOUBLE)" for i in range(count))
    return f""",
th AS (SELECT * FROM (VALUES {rows}) AS v(threshold)),
cm AS (
  SELECT model, threshold,
         (count(*) FILTER (WHERE label = 1 AND probability >= threshold))::DOUBLE AS tp,
         (count(*) FILTER (WHERE label = 0 AND probability >= threshold))::DOUBLE AS fp,
         (count(*) FILTER (WHERE label = 1 AND probability < threshold))::DOUBLE AS fn,
         (count(*) FILTER (WHERE label = 0 AND probability < threshold))::DOUBLE AS tn
  FROM preds, th GROUP BY model, threshold
)
"""


EDGES = ", ".join(f"{0.1 * i!r}::DOUBLE" for i in range(1, 10))

SQL = {
    "confusion_counts": CM
    + "---\nSELECT model, tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, tn::BIGINT AS tn FROM cm",
    "classification_metrics": CM
    + f"""---
SELECT model, (tp + fp + fn + tn)::BIGINT AS n_samples, (tp + fn)::BIGINT AS n_positive,
       (fp + tn)::BIGINT AS n_negative, {_rates(*RATES)} FROM cm""",
    "roc_auc": PREDS + RANKS + "---\nSELECT * FROM auc",
    "average_precision": PREDS + RANKS + "---\nSELECT * FROM ap",
    "brier": PREDS
    + "---\nSELECT model, avg((probability - label) * (probability - label)) AS brier_score FROM preds GROUP BY model",
    "cost_total": CM
    + f"---\nSELECT model, {COST} AS cost_total, ({COST}) / (tp + fp + fn + tn) AS cost_per_sample FROM cm",
    "phm_score": CM
    + f"---\nSELECT model, greatest(0, 1 - (0.1::DOUBLE * {RATES['fpr']} + {RATES['fnr']}) / 1.1::DOUBLE) AS phm_score FROM cm",
    "lead_time": PREDS
    + """---
SELECT model, avg(time_to_failure_hours) FILTER (WHERE prediction = 1) AS mean_detection_lead_time,
       median(time_to_failure_hours) FILTER (WHERE prediction = 1) AS median_detection_lead_time,
       avg(prediction) AS detection_rate
FROM preds WHERE label = 1 GROUP BY model""",
    "prognostic_horizon_rows": PREDS
    + """---
SELECT model, time_to_failure_hours AS prognostic_horizon_hours FROM preds
WHERE label = 1 AND probability >= 0.5
QUALIFY row_number() OVER (PARTITION BY model ORDER BY timestamp DESC, machine_id DESC) = 1""",
    "compare_models": CM
    + RANKS
    + f"""---
SELECT model, {_rates('accuracy', 'precision', 'recall', 'f1_score', 'mcc')}, roc_auc, avg_precision,
       {COST} AS cost_total, ({COST}) / (tp + fp + fn + tn) AS cost_per_sample
FROM cm JOIN auc USING (model) JOIN ap USING (model)""",
    "threshold_table": PREDS
    + _thresholds(0.1, 18)
    + f"---\nSELECT model, threshold, {_rates('precision', 'recall', 'f1_score', 'fpr', 'fnr')}, {COST} AS cost_total FROM cm",
    "cost_curve": PREDS
    + _thresholds(0.05, 19)
    + f"""---
SELECT model, threshold, {_rates('precision', 'recall')}, {COST} AS cost,
       row_number() OVER (PARTITION BY model ORDER BY {COST}, threshold) = 1 AS is_best
FROM cm""",
    "roc_curve": PREDS
    + RANKS
    + """---
SELECT model, cfp / n::DOUBLE AS fpr, ctp / p::DOUBLE AS tpr, probability AS threshold FROM pr
UNION ALL SELECT DISTINCT model, 0::DOUBLE, 0::DOUBLE, CAST(NULL AS DOUBLE) FROM preds""",
    "pr_curve": PREDS
    + RANKS
    + """---
SELECT model, ctp / (ctp + cfp)::DOUBLE AS precision, ctp / p::DOUBLE AS recall, probability AS threshold FROM pr
UNION ALL SELECT DISTINCT model, 1::DOUBLE, 0::DOUBLE, CAST(NULL AS DOUBLE) FROM preds""",
    "calibration": PREDS
    + f"""---
SELECT model, CAST(len(list_filter([{EDGES}], lambda e: e < probability)) AS INTEGER) AS bin,
       avg(probability) AS mean_predicted, avg(label) AS fraction_positive, count(*) AS n
FROM preds GROUP BY 1, 2""",
    "model_report": CM
    + RANKS
    + f"""---
SELECT model, {_rates('accuracy', 'precision', 'recall', 'f1_score', 'mcc')}, roc_auc, avg_precision,
       {COST} AS expected_cost, ({COST}) / (tp + fp + fn + tn) AS cost_per_sample,
       fp::BIGINT AS fp_count, fn::BIGINT AS fn_count, tp::BIGINT AS tp_count, tn::BIGINT AS tn_count
FROM cm JOIN auc USING (model) JOIN ap USING (model)""",
    "confusion_cost_cells": PREDS
    + """,
cells AS (
  SELECT model, CASE WHEN label = 1 AND prediction = 1 THEN 'TP' WHEN label = 1 THEN 'FN'
                     WHEN prediction = 1 THEN 'FP' ELSE 'TN' END AS cell FROM preds
),
units AS (SELECT * FROM (VALUES ('TN', 0::DOUBLE), ('FP', 500), ('FN', 12000), ('TP', 500)) AS v(cell, unit_cost)),
models AS (SELECT DISTINCT model FROM preds)
---
SELECT m.model, u.cell, count(c.cell) AS n, unit_cost, count(c.cell) * unit_cost AS total_cost
FROM models m CROSS JOIN units u LEFT JOIN cells c ON c.model = m.model AND c.cell = u.cell
GROUP BY m.model, u.cell, unit_cost""",
    "tuned_threshold": PREDS
    + RANKS
    + """---
SELECT model, probability AS threshold, (cfp * 500 + (p - ctp) * 12000)::DOUBLE AS cost FROM pr
QUALIFY row_number() OVER (PARTITION BY model ORDER BY cfp * 500 + (p - ctp) * 12000, probability) = 1""",
    "ensemble_vote": PREDS
    + """,
v AS (
  SELECT a.machine_id, a.timestamp, a.label, (2 * a.probability + b.probability) / 3 AS probability
  FROM preds a JOIN preds b USING (machine_id, timestamp) WHERE a.model = 'A' AND b.model = 'B'
)
---
SELECT *, CAST(probability >= 0.5 AS INTEGER) AS prediction FROM v""",
}
