"""Registered queries: ETA models, route-type classifier and model comparison.

All models run at their full settings, boosting for all its rounds on all
training rows.  These are property-checked (no SQL oracle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import decision as D
from ..operators import ml as ML
from ..operators.features import FEATURE_COLS, MEAN_COLS, TARGET_COL
from ..operators.graph.core import cut
from .analysis_q import features
from .registry import finish, query


def _written(trips, cols):
    # iterative fitting re-reads its input many times: materialise what the models read, once
    return cut(trips.select(*dict.fromkeys(["trip_uuid", "data", "route_type", *MEAN_COLS, TARGET_COL, "osrm_time", *cols])))


def _split(spark, sf_dir):
    return ML.train_test(_written(features(spark, sf_dir), FEATURE_COLS))


def _graph_split(spark, sf_dir):
    from ..operators.graph import stats as S
    from .graph_q import cent, embeddings, graph
    v, e = graph(spark, sf_dir)
    gs = S.graph_statistics(v, e, cent(v, e))
    m = S.merge_graph_features(features(spark, sf_dir), embeddings(v, e), gs)
    cols = FEATURE_COLS + [c for c in m.columns if c.startswith(("src_", "dst_"))]
    return *ML.train_test(_written(m, cols)), cols


@query("linreg_eta")
def _lin(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    return D.eval_metrics(ML.linreg_eta(tr, te))


@query("rf_eta")
def _rf(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    return D.eval_metrics(ML.rf_eta(tr, te)[0])


@query("gbt_eta")
def _gbt(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    return D.eval_metrics(ML.gbt_eta(tr, te))


def _all(spark, *fits):
    """Predictions of several models, fitted side by side."""
    from functools import reduce
    return reduce(DataFrame.unionByName, ML.at_once(spark, fits))


@query("gbt_settings_eta")
def _gbt_settings(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    return D.eval_metrics(_all(spark, *[lambda s=s: ML.gbt_eta(tr, te, setting=s, beside=2) for s in ("gbt_leafwise", "gbt_symmetric")]))


def _graph_boosters(tr, te, cols, beside=1):
    return [lambda s=s: ML.gbt_eta(tr, te, cols, s, f"graph_{s}", beside=beside) for s in ("gbt", "gbt_leafwise", "gbt_symmetric")]


@query("residual_eta")
def _res(spark, sf_dir):
    tr, te, cols = _graph_split(spark, sf_dir)
    return D.eval_metrics(ML.gbt_eta(tr, te, cols, "residual_gbt", residual=True))


@query("graph_gbt_eta")
def _ggbt(spark, sf_dir):
    tr, te, cols = _graph_split(spark, sf_dir)
    return D.eval_metrics(_graph_boosters(tr, te, cols)[0]())


@query("graph_gbt_settings_eta")
def _ggbt_settings(spark, sf_dir):
    tr, te, cols = _graph_split(spark, sf_dir)
    return D.eval_metrics(_all(spark, *_graph_boosters(tr, te, cols, 2)[1:]))


@query("feature_importance")
def _imp(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    return finish(ML.feature_importance(spark, ML.rf_eta(tr, te)[1]))


@query("route_type_classifier")
def _clf(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    return finish(ML.route_type_classifier(tr, te))


def _comparison(spark, sf_dir):
    """Predictions of every model: planned time, tabular, residual and graph-enhanced."""
    tr, te, cols = _graph_split(spark, sf_dir)
    planned = te.select(F.lit("planned_time").alias("model"), "trip_uuid", F.col("actual_time").alias("y"),
                        F.col("osrm_time").alias("y_pred"), F.col("osrm_time").alias("osrm"))
    n = 9                                                    # fits, the longest first
    fits = [lambda: ML.gbt_eta(tr, te, cols, "residual_gbt", residual=True, beside=n), *_graph_boosters(tr, te, cols, n),
            lambda: ML.rf_eta(tr, te)[0], *[lambda s=s: ML.gbt_eta(tr, te, setting=s, beside=n) for s in ("gbt", "gbt_leafwise", "gbt_symmetric")],
            lambda: ML.linreg_eta(tr, te)]
    return cut(planned.unionByName(_all(spark, *fits)))


@query("model_comparison")
def _cmp(spark, sf_dir):
    return D.compare_models(D.eval_metrics(_comparison(spark, sf_dir)))


@query("model_improvement")
def _impr(spark, sf_dir):
    return finish(D.model_improvement(D.eval_metrics(_comparison(spark, sf_dir)), "planned_time"))


@query("best_model_business_metrics")
def _best(spark, sf_dir):
    preds = _comparison(spark, sf_dir)
    metrics = D.eval_metrics(preds)
    best = D.best_model(metrics).withColumnRenamed("best_model", "model")
    chosen = preds.join(F.broadcast(best), "model")  # one-row selection
    return finish(D.business_metrics(chosen))
