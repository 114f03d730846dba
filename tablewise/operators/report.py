"""Report pieces: preview rows (P7) and the report bundle.

The bundle gathers outputs that are already small (one row per column, per
month, per feature or per class); each is computed by Spark and only the
summary rows are collected to build the JSON document.
"""
from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession

from .. import constants as K
from ..functions.scalars import col_


def preview(df: DataFrame, key: str, rows: int = K.PREVIEW_ROWS) -> DataFrame:
    """First ``rows`` rows in ``key`` order (per-task top-k, then merged)."""
    return df.orderBy(col_(key)).limit(rows)


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def _jsonable(v):
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, float) and v != v:
        return None
    if isinstance(v, dict):
        return {k: _jsonable(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [_jsonable(x) for x in v]
    return v


def column_summaries(df: DataFrame) -> list[dict]:
    """A1-A5 merged per column: summary, numeric describe + histogram, or top values."""
    from . import profile as P
    st = P.basic_stats(df)  # one pass shared by the three profiles below
    summ = {r["column_name"]: r for r in _rows(P.column_summary(df, stats=st))}
    desc = {r["column_name"]: r for r in _rows(P.numeric_describe(df, stats=st))}
    hist: dict[str, list] = {}
    for r in _rows(P.histogram(df, stats=st)):
        hist.setdefault(r["column_name"], []).append(r)
    tops: dict[str, list] = {}
    for r in _rows(P.top_categories(df)):
        tops.setdefault(r["column_name"], []).append(r)
    out = []
    for c in df.columns:
        s = summ[c]
        info = {"name": c, "dtype": s["dtype"], "missing": s["missing"], "unique": s["n_unique"], "kind": s["kind"]}
        if s["kind"] == "numeric":
            d = desc[c]
            info.update({k: d[k] for k in ("mean", "std", "min", "q25", "median", "q75", "max")})
            bins = sorted(hist.get(c, []), key=lambda r: r["bin"])
            info["histogram"] = {"counts": [b["cnt"] for b in bins],
                                 "edges": [b["lo"] for b in bins] + ([bins[-1]["hi"]] if bins else [])}
        elif s["kind"] == "datetime":
            info["min"], info["max"] = s["min_value"], s["max_value"]
        else:
            info["top_values"] = {r["value"]: r["cnt"] for r in sorted(tops.get(c, []), key=lambda r: r["rank"])}
        out.append(info)
    return out


def generate(spark: SparkSession, cleaned: DataFrame, features: DataFrame, key: str, ingest_meta: dict,
             clean_report: dict, feature_meta: dict, train_meta: dict, metrics: dict, deployment: dict,
             model_path: str | None = None) -> dict:
    """Everything the dashboard shows, as one JSON-ready dict."""
    from . import model as M
    from . import profile as P
    from . import timeseries as TS
    data = cleaned.drop(key) if key in cleaned.columns else cleaned
    target = feature_meta.get("target_name")
    mapping = feature_meta.get("label_mapping")
    label_map = (spark.createDataFrame([(k, v) for k, v in mapping.items()], "value string, code bigint")
                 if mapping else None)
    importances = train_meta.get("feature_importances", {})
    feat_cols = [c for c in features.columns if c not in (key, target, "is_test")]
    ordered = [c for c in importances if c in feat_cols] + [c for c in feat_cols if c not in importances]
    ranges = {r["feature"]: {"min": r["min"], "max": r["max"], "mean": r["mean"]}
              for r in _rows(M.feature_ranges(features, ordered))}
    monthly, summary = TS.time_kpis(data, target=target)
    srow = _rows(summary)[0]
    if srow.get("available"):
        m = sorted(_rows(monthly), key=lambda r: r["month_idx"])
        kpis = {"available": True, "date_column": srow["date_column"], "metric_column": srow["metric_column"],
                "agg": "monthly total", "periods": [r["period"] for r in m],
                "values_sum": [r["value_sum"] for r in m], "values_mean": [r["value_mean"] for r in m],
                "values_count": [r["value_count"] for r in m], "mom_pct": [r["mom_pct"] for r in m],
                "yoy_pct": [r["yoy_pct"] for r in m],
                "summary": {k: v for k, v in srow.items() if k not in ("available", "reason", "date_column", "metric_column")}}
    else:
        kpis = {"available": False, "reason": srow.get("reason")}
    pre = P.correlation_pairs(data, target, label_map)  # one computation for the three views
    top = _rows(P.top_correlations(data, target, label_map, pre=pre))
    tgt = _rows(P.target_correlations(data, target, label_map, pre=pre)) if target in data.columns else []
    corr_rows = _rows(P.correlation_matrix(data, target, label_map, pre=pre))
    if corr_rows:
        cols = [r["col_a"] for r in sorted(corr_rows, key=lambda r: (r["i"], r["j"])) if r["j"] == 0]
        k = len(cols)
        mat = [[0.0] * k for _ in range(k)]
        for r in corr_rows:
            mat[r["i"]][r["j"]] = r["r"]
        correlations = {"columns": cols, "matrix": mat, "target": target if target in cols else None}
    else:
        correlations = None
    prev = _rows(preview(cleaned, key).drop(key)) if key in cleaned.columns else _rows(cleaned.limit(K.PREVIEW_ROWS))
    bundle = {
        "generated_at": _dt.datetime.now(_dt.timezone.utc).isoformat(),
        "dataset": {"name": ingest_meta.get("source_name"), "rows": clean_report.get("rows_after"),
                    "columns": len(data.columns), "ingested_at": ingest_meta.get("ingested_at"),
                    "raw_rows": ingest_meta.get("n_rows"), "raw_columns": ingest_meta.get("n_cols")},
        "cleaning": clean_report,
        "task": {"type": feature_meta.get("task_type"), "target": target,
                 "n_features": feature_meta.get("n_features"), "n_classes": feature_meta.get("n_classes"),
                 "class_names": feature_meta.get("class_names")},
        "metrics": metrics, "deployment": deployment,
        "feature_importances": dict(list(importances.items())[:K.MAX_TOP_FEATURES]),
        "model": {"path": model_path, "type": train_meta.get("model_type"),
                  "features": train_meta.get("feature_columns")},
        "feature_inputs": {c: ranges[c] for c in ordered if c in ranges},
        "kpis": kpis,
        "insights": {"top_correlations": top, "target_correlations": tgt},
        "column_summaries": column_summaries(data),
        "correlations": correlations,
        "preview_rows": prev,
    }
    return _jsonable(bundle)


def bundle_frame(spark: SparkSession, bundle: dict) -> DataFrame:
    """The bundle as one row: headline fields plus the whole document as JSON text."""
    row = (bundle["dataset"]["name"], bundle["task"]["type"], bundle["task"]["target"],
           bundle["kpis"].get("available"), len(bundle["column_summaries"]),
           json.dumps(bundle, default=str))
    return spark.createDataFrame([row], "dataset string, task_type string, target string, kpis_available boolean, "
                                        "n_columns int, bundle string")

