"""The report over everything."""

from __future__ import annotations


from riskloom.catalog import sql
from riskloom.catalog.evaluating import (
    COEFFICIENTS,
    COMPARISON,
    IMPORTANCE,
    LINEAR,
    PROMOTION,
    PROMOTION_BLOCKS,
    PROMOTION_ROWS,
    linear_holdout,
    promotion_rows,
    rounded,
)
from riskloom.catalog.registry import query
from riskloom.catalog.relational import COLS, REPORT_ROWS, SUMMARY, both_models, interim
from riskloom.catalog.watching import DRIFT
from riskloom.operators import drift, encodings, explaining, modelling, ranking, selection, splitting, validation
from riskloom.plans import promotion
from riskloom.session import materialize


def _rows(section: str, source: str, fields: dict[str, str] | list[str]) -> str:
    pairs = fields.items() if isinstance(fields, dict) else ((f, f) for f in fields)
    return "".join(
        f" UNION ALL SELECT {section}, '{name}', CAST({expr} AS DOUBLE) FROM {source}" for name, expr in pairs
    )


_PUBLISHED = {
    "baseline": modelling.BASELINE_PARAMS,
    "candidate": {k: v for k, v in modelling.BOOSTED_PARAMS.items() if k != "scale_pos_weight"},
}
_BODY = (
    "SELECT 'dataset.' || stage AS section, check_name AS name, value FROM vr WHERE severity = 'stat'"
    + "".join(
        f" UNION ALL SELECT 'parameters.{model}', '{name}', CAST({value} AS DOUBLE)"
        for model, told in _PUBLISHED.items() for name, value in told.items()
    )
    + _rows(
        "'parameters.candidate'", "(SELECT is_fraud FROM sp WHERE split = 'train')",
        {"scale_pos_weight": "CAST(count(*) FILTER (WHERE is_fraud = 0) AS DOUBLE) / count(*) FILTER (WHERE is_fraud = 1)"},
    )
    + _rows(
        "'dataset.test'", "(SELECT device_type FROM sp WHERE split = 'holdout')",
        {"identity_coverage": "round(CAST(count(device_type) AS DOUBLE) / count(*), 4)", "rows": "count(*)", "n_columns": "max(11)"},
    )
    + _rows("'split.' || split", "summary", ["rows", "fraud_rate", "n_positives"])
    + _rows("'model.' || model || '.' || split", "cm", ["pr_auc", "roc_auc", "n", "positives"])
    + _rows(
        "'comparison.' || split",
        "(SELECT * FROM cw WHERE split <> 'train')",
        {
            "pr_auc_delta": "candidate_pr_auc - baseline_pr_auc",
            "roc_auc_delta": "candidate_roc_auc - baseline_roc_auc",
            "candidate_beats_baseline": "candidate_pr_auc > baseline_pr_auc",
        },
    )
    + " UNION ALL SELECT 'promotion.' || section, name, value FROM pr"
    + " UNION ALL SELECT 'explainability', feature, importance FROM imp"
    + _rows(
        "'monitoring'",
        "(SELECT count(*) FILTER (WHERE w1_norm >= 0.1) AS a, count(*) AS b FROM dr)",
        {"drifted_columns": "a", "total_columns": "b", "dataset_drift": "CAST(a AS DOUBLE) / b >= 0.5"},
    )
)


@query(
    "final_report_table",
    sql.with_(
        f"SELECT section, name, round(value, 6) AS value FROM ({_BODY})",
        *PROMOTION_BLOCKS, "feats",
        vr=REPORT_ROWS, summary=SUMMARY, **COMPARISON,
        cm=f"""SELECT model, split, {sql.AP} AS pr_auc, {sql.AUC} AS roc_auc, sum(n) AS n, sum(pos) AS positives
        FROM cc GROUP BY model, split""",
        **PROMOTION, pr=PROMOTION_ROWS, **LINEAR, imp=IMPORTANCE, **DRIFT,
    ),
)
def final_report_table(spark, sf):
    joined = interim(spark, sf)
    t1, t2 = splitting.boundary_values(splitting.split_boundaries(joined, cols=COLS))
    metrics = materialize(ranking.evaluate(both_models(spark, sf), ["model", "split"]), "metrics")
    importance = explaining.global_importance(
        linear_holdout(spark, sf), "contributions", list(COEFFICIENTS), 30
    )
    rows = splitting.assign_split(joined, t1, t2, COLS).withColumns(encodings.row_expressions(joined, COLS))
    train, holdout = rows.where("split = 'train'"), rows.where("split = 'holdout'")
    columns = drift.drift_columns(train, holdout, "is_fraud")
    unlabelled = splitting.assign_split(joined, t1, t2, COLS).where("split = 'holdout'").drop("split", "is_fraud")
    ratio = modelling.scale_pos_weight(train, "is_fraud").first()["scale_pos_weight"]
    told = [(m, n, float(v)) for m, settings in _PUBLISHED.items() for n, v in settings.items()] + [("candidate", "scale_pos_weight", ratio)]
    out = promotion.final_report(
        validation.validation_report(joined, "train", COLS),
        splitting.split_summary(joined, t1, t2, COLS),
        metrics,
        selection.compare_models(metrics.where("split <> 'train'")),
        promotion_rows(spark, sf),
        importance,
        drift.dataset_drift(drift.column_drift(train, holdout, columns)),
        top_n=10,
        test_validation=validation.validation_report(unlabelled, "test", COLS, ("identity_coverage", "rows", "n_columns")),
        parameters=spark.createDataFrame(told, "model string, name string, value double"),
    )
    return rounded(out, "value")
