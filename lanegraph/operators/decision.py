"""Evaluation, business metrics, scenarios and bottleneck KPIs.

Metrics are single global (or per-model) aggregates over prediction
tables; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import severity_band
from .aggregate import one_row_join

# Business assumptions of the decision metrics.
AVG_SHIPMENT_VALUE = 500
LATE_PENALTY_RATE = 0.10
LATE_FACTOR = 0.85

# What-if upgrade actions (delay reduction share, capex in lakh).
UPGRADE_ACTIONS = [
    ("Add +20% FTL Truck Capacity", 0.35, 12.5, False),
    ("Deploy Automated Sorter (Hub Only)", 0.45, 45.0, True),
    ("Optimize Process Flow (-15% Handling Time)", 0.15, 2.0, False),
    ("Reroute Non-Urgent Carting Traffic", 0.25, 0.0, False),
]
# Thresholds of the severity bands and of a short payback.
HUB_BANDS = (70, 40)
CORRIDOR_BANDS = (60, 30)
SHORT_PAYBACK_MONTHS = 3
BASE_SLA_BREACH = 0.18
PENALTY_PER_BREACH = 25

# Network-level penalty assumptions of the executive view.
DAILY_PACKAGES = 1_500_000
RECOVERY_SHARE = 0.35


def _present(y: Column, p: Column) -> Column:
    return y.isNotNull() & p.isNotNull() & ~F.isnan(y) & ~F.isnan(p)


def eval_metrics(preds: DataFrame, y: str = "y", p: str = "y_pred", model: str = "model") -> DataFrame:
    """MAE, RMSE, MAPE, R², Acc@10/15/20 % per model (pairs with a missing side dropped)."""
    yc, pc = F.col(y), F.col(p)
    ok = preds.where(_present(yc, pc))
    err = F.abs(yc - pc)
    rel = F.when(yc != 0, err / F.abs(yc))
    nz = F.count_if(yc != 0)
    sst = F.var_pop(yc) * F.count("*")

    def acc(k):
        return F.when(nz > 0, F.avg(F.when(yc != 0, (rel <= k).cast("double"))) * 100).otherwise(F.lit(0.0))

    g = ok.groupBy(model) if model in preds.columns else ok.groupBy()
    out = g.agg(
        F.round(F.avg(err), 2).alias("MAE"),
        F.round(F.sqrt(F.avg(err * err)), 2).alias("RMSE"),
        F.round(F.avg(rel) * 100, 2).alias("MAPE"),
        F.round(F.when(sst > 0, F.lit(1.0) - F.sum(err * err) / sst).otherwise(F.lit(0.0)), 4).alias("R2"),
        F.round(acc(0.10), 2).alias("Acc_10"),
        F.round(acc(0.15), 2).alias("Acc_15"),
        F.round(acc(0.20), 2).alias("Acc_20"),
    )
    return out


def compare_models(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.desc("R2"), "model")


def best_model(metrics: DataFrame, by: str = "R2") -> DataFrame:
    """Model chosen by metric (higher R²), not by list position."""
    return metrics.agg(F.max_by("model", F.struct(F.col(by), F.col("model"))).alias("best_model"))


def model_improvement(metrics: DataFrame, baseline: str) -> DataFrame:
    """MAE improvement % of every model against ``baseline``."""
    base = metrics.where(F.col("model") == baseline).select(F.col("MAE").alias("_base_mae"))
    return (one_row_join(metrics, base)
            .withColumn("mae_improvement_pct",
                        F.when(F.col("_base_mae") > 0,
                               (F.col("_base_mae") - F.col("MAE")) / F.col("_base_mae") * 100))
            .drop("_base_mae"))


def business_metrics(preds: DataFrame, y: str = "y", p: str = "y_pred", osrm: str | None = "osrm") -> DataFrame:
    yc, pc = F.col(y), F.col(p)
    nz = yc > 0
    rel = F.when(nz, F.abs(yc - pc) / yc)
    late = pc < yc * LATE_FACTOR

    def acc(k, r=rel):
        return F.avg(F.when(nz, (r <= k).cast("double"))) * 100

    aggs = [acc(0.10).alias("accuracy_at_10"), acc(0.15).alias("accuracy_at_15"),
            acc(0.20).alias("accuracy_at_20"), acc(0.30).alias("accuracy_at_30"),
            (F.avg(F.when(nz, late.cast("double"))) * 100).alias("late_delivery_rate"),
            F.avg(F.abs(yc - pc)).alias("avg_prediction_error_min")]
    if osrm:
        oc = F.col(osrm)
        orel = F.when(nz, F.abs(yc - oc) / yc)
        aggs += [acc(0.15, orel).alias("osrm_accuracy_at_15"),
                 (acc(0.15) - acc(0.15, orel)).alias("improvement_over_osrm"),
                 F.avg(F.abs(yc - oc)).alias("osrm_avg_error_min")]
    aggs.append((F.count_if(late) * AVG_SHIPMENT_VALUE * LATE_PENALTY_RATE).alias("estimated_revenue_at_risk"))
    from .quantiles import one_quantiles
    error = preds.select(F.abs(yc - pc).alias("_e"))
    return one_row_join(preds.agg(*aggs), one_quantiles(error, "_e", {"median_prediction_error_min": 0.5}))


def _actions(hub: bool) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("action"), F.lit(r).alias("delay_reduction_pct"),
                              F.lit(c).alias("capex_lakh"))
                     for n, r, c, hub_only in UPGRADE_ACTIONS if hub or not hub_only])


def upgrade_scenarios(targets: DataFrame, key_cols, current_delay: Column, throughput: Column,
                      hub: bool, base_sla: float = BASE_SLA_BREACH,
                      penalty: float = PENALTY_PER_BREACH) -> DataFrame:
    """Every target × every applicable action (generated per row, no join)."""
    t = targets.select(*key_cols, current_delay.alias("current_delay"),
                       throughput.cast("double").alias("throughput"),
                       F.explode(_actions(hub)).alias("a")).select("*", "a.*").drop("a")
    r = F.col("delay_reduction_pct")
    cur_loss = F.col("throughput") * base_sla * penalty
    new_loss = F.col("throughput") * (F.lit(base_sla) * (1 - r)) * penalty
    annual = (cur_loss - new_loss) * 365 / 100000
    return t.withColumns({
        "projected_delay": F.col("current_delay") * (1 - r),
        "new_sla_breach": F.lit(base_sla) * (1 - r),
        "annual_recovery_lakh": annual,
    }).withColumn("payback_months",
                  F.when((F.col("capex_lakh") > 0) & (F.col("annual_recovery_lakh") > 0),
                         F.col("capex_lakh") / (F.col("annual_recovery_lakh") / 12)).otherwise(F.lit(0.0))).withColumns({
        "net_first_year_lakh": annual - F.col("capex_lakh"),
        "breaches_prevented": F.col("throughput") * (F.lit(base_sla) - F.lit(base_sla) * (1 - r)),
        "recommendation": scenario_recommendation(F.col("payback_months"))})


def scenario_recommendation(payback_months: Column) -> Column:
    """``deploy`` without a payback period, ``approve`` with a short one, else ``consider_others``."""
    return (F.when(payback_months == 0, F.lit("deploy")).when((payback_months > 0) & (payback_months < SHORT_PAYBACK_MONTHS), F.lit("approve"))
            .otherwise(F.lit("consider_others")))


def corridor_severity(corridors: DataFrame) -> DataFrame:
    """High/Medium/Low band of every corridor's impact."""
    return corridors.withColumn("severity", severity_band("corridor_impact", *CORRIDOR_BANDS))


def hub_severity(hubs: DataFrame) -> DataFrame:
    """High/Medium/Low band of every hub's normalised impact."""
    return hubs.withColumn("severity", severity_band("impact_score_normalized", *HUB_BANDS))


def corridor_scenarios(corridors: DataFrame) -> DataFrame:
    return upgrade_scenarios(corridors, ["source_center", "destination_center"],
                             F.col("actual_time_mean"), F.col("trip_count"), hub=False)


def hub_scenarios(hubs: DataFrame) -> DataFrame:
    return upgrade_scenarios(hubs, ["facility_id"], F.col("impact_score_normalized") * 1.5,
                             F.col("throughput"), hub=True)


def bottleneck_kpis(hubs: DataFrame, corridors: DataFrame, hub_threshold: float = 70,
                    corridor_threshold: float = 60) -> DataFrame:
    h = hubs.agg(F.count_if(F.col("impact_score_normalized") > hub_threshold).alias("critical_hubs"))
    c = corridors.agg(F.count_if(F.col("corridor_impact") > corridor_threshold).alias("critical_corridors"),
                      F.avg("sla_breach_pct").alias("mean_corridor_sla_breach"))
    return one_row_join(h, c)


def hub_daily_risk(hubs: DataFrame, sla_share: float = BASE_SLA_BREACH,
                   penalty: float = PENALTY_PER_BREACH) -> DataFrame:
    return hubs.withColumn("daily_risk", F.col("throughput") * F.col("impact_score_normalized") / 100
                           * sla_share * penalty)


def sla_penalty_kpis(hubs: DataFrame, packages: int = DAILY_PACKAGES, sla_share: float = BASE_SLA_BREACH,
                     penalty: float = PENALTY_PER_BREACH, recovery: float = RECOVERY_SHARE) -> DataFrame:
    daily = packages * sla_share * penalty
    return hub_daily_risk(hubs, sla_share, penalty).agg(
        F.lit(float(daily)).alias("daily_penalty"),
        F.lit(float(daily * 365)).alias("annual_penalty"),
        F.lit(float(daily * 365 * recovery)).alias("recoverable_annual"),
        F.sum("daily_risk").alias("hub_daily_risk_total"))
