"""End-to-end plans of the four entry points of the original study.

A. ``build_samples``  raw orders -> labelled revival samples (R2-R10)
B. ``build_features`` samples -> 57 features (F1-F6, cleanup P7)
C. ``fit_and_evaluate`` features -> model, scores, metric tables (M1-M18)
D. ``parameter_study`` orders -> sweeps of thresholds and windows (A9-A16)

Lineage is cut (a Parquet table below the cluster's ``spark.checkpoint.dir``,
or persist when none is configured) exactly where the original pipeline has a
process boundary or a table is consumed by several branches: the sample table,
the de-duplicated stage-2 order table and the feature matrix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame

from ..config import RevivalConfig
from ..operators import events as EV
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import model as MD
from ..operators import quality as Q
from ..operators import study as ST
from ..operators import timeline as TL
from ..session import cut_lineage


def build_samples(orders: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """Entry A: canonical orders -> sample table (the numbered rows are
    materialised once, by the numbering)."""
    return EV.samples(orders, cfg)


def build_features(samples: DataFrame, orders: DataFrame, lines: DataFrame, members: DataFrame,
                   cfg: RevivalConfig, clean: bool = True, orders_fl: DataFrame | None = None) -> DataFrame:
    """Entry B: samples + raw tables -> feature matrix (materialised).

    ``orders_fl`` is the flagged stage-2 order table if it is stored already (in
    buckets of the order code by ``session.bucketed``, the t0 lookup exchanges no order).  Fails if a member has two rows, or if the joins changed the number of rows."""
    if orders_fl is None:
        orders_fl = cut_lineage(TL.scan_orders_flagged(orders, cfg))
    feats = FE.assemble_features(samples, orders_fl, FE.scan_lines_valid(lines, cfg),
                                 FE.scan_members(members), cfg)
    out = cut_lineage(FE.clean_ranges(feats, cfg) if clean else feats)
    n, m = samples.count(), out.count()
    if n != m:
        raise ValueError(f"{n} samples became {m} feature rows")
    return out


def feature_sanity(features: DataFrame, samples: DataFrame | None = None, orders: DataFrame | None = None,
                   cfg: RevivalConfig | None = None) -> dict[str, DataFrame]:
    """A29-A31 tables over the feature matrix; the leakage audit (A32) if the
    samples and orders it needs are given."""
    num = [c for c in FE.FEATURE_COLS if c not in FE.CATEGORICAL_COLS]
    miss = Q.missing_rates(features)
    quant, extreme = Q.quantile_tables(features, num, [c for c in FE.RATIO_FEATURES if c in features.columns])
    out = {"missing_rates": miss, "group_missing": Q.group_missing_median(miss),
           "quantiles": quant, "extreme_values": extreme}
    if samples is not None and orders is not None:
        out["leakage_audit"] = FE.leakage_audit(samples, TL.scan_orders_flagged(orders, cfg), cfg)
    return out


def fit_and_evaluate(features: DataFrame, cfg: RevivalConfig, max_iter: int = 40,
                     model_path: str | None = None) -> dict[str, DataFrame]:
    """Entry C: train on the train split, score both splits, metric tables.

    ``model_path``: where to save the fitted model."""
    cols = MD.feature_columns(features)
    train = features.filter("split = 'train'")
    test = features.filter("split = 'test'")
    model = MD.train_gbt(train, cols, cfg.seed, max_iter=max_iter)
    if model_path:
        MD.save_model(model, model_path)
    scored = cut_lineage(MD.score_split(model, features))
    num = [c for c in cols if c not in FE.CATEGORICAL_COLS]
    test_scored = scored.filter("split = 'test'").join(
        features.select("sample_id", *num), "sample_id")
    importance = MD.gain_importance(model, cols, features)
    attribution = cut_lineage(MD.permutation_importance(model, test, cols, cfg.seed))
    top = M.topk(attribution.drop("rank"), "delta_auc", 5)
    return {
        "scored": scored,
        "metrics": M.metric_table(scored),
        "auc_gap": M.auc_gap(scored),
        "class_report": M.class_report(scored),
        "tiers": M.tiers(scored, lo=cfg.mid_lo, hi=cfg.mid_hi),
        "calibration": M.midband_calibration(scored),
        "histogram": M.score_histogram(scored.filter("split = 'test'")),
        "midband_share": M.midband_share(scored, lo=cfg.mid_lo, hi=cfg.mid_hi),
        "smd": M.smd_profile(test_scored, num, cfg.mid_lo, cfg.mid_hi),
        "importance": importance,
        "attribution": attribution,
        "importance_overlap": M.topk_overlap(importance, attribution),
        "direction": M.direction(test_scored, num).join(top.select("feature", "rank"), "feature"),
        "key_feature_ranks": MD.key_feature_ranks(attribution, FE.WATCH_LIST),
        "ablation": MD.ablation(train, test, cols, cfg.snapshot_cols, cfg.seed, max_iter=max_iter),
    }


class Study(Mapping[str, DataFrame]):
    """Tables by name, each planned when it is first asked for.

    Tables that several others read are stored once, by the first that needs them."""

    def __init__(self, tables: dict[str, Callable[[Study], DataFrame]], shared: dict[str, Callable[[], DataFrame]]):
        self._tables, self._shared = tables, shared
        self._found: dict[str, DataFrame] = {}

    def shared(self, name: str) -> DataFrame:
        if name not in self._found:
            self._found[name] = cut_lineage(self._shared[name]())
        return self._found[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables[name](self)

    def __contains__(self, name: object) -> bool:
        return name in self._tables

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


def parameter_study(orders: DataFrame, cfg: RevivalConfig) -> Study:
    """Entry D: the exploratory sweeps in a handful of passes over one gap table.

    Nothing runs before a table is asked for."""
    gaps, unique, days = (lambda s: s.shared("gaps")), (lambda s: s.shared("unique")), (lambda s: s.shared("day_gaps"))
    per_member = lambda s: unique(s).filter("member_id is not null").groupBy("member_id").count()
    return Study({
        "overview": lambda s: TL.table_overview(orders),
        "status_share": lambda s: TL.value_share(orders, "status"),
        "sign_shares": lambda s: TL.sign_shares(orders),
        "purchase_counts": lambda s: TL.purchase_count_dist(unique(s)),
        "purchase_count_histogram": lambda s: ST.histogram(per_member(s), "count", 59, kind="log"),
        "item_counts": lambda s: TL.item_count_dist(unique(s)),
        "sku_histogram": lambda s: ST.histogram(unique(s), "ts_count", 0, kind="unit", clip_upper=20),
        "qty_histogram": lambda s: ST.histogram(unique(s), "qty", 0, kind="unit", clip_upper=30),
        "static_cycle": lambda s: TL.static_ci_stats(days(s), unique(s)),
        "gap_dist": lambda s: TL.gap_dist(days(s)),
        "threshold_sweep": lambda s: ST.threshold_sweep(gaps(s), cfg),
        "window_sweep": lambda s: ST.window_sweep(gaps(s), cfg),
        "k_m_grid": lambda s: ST.k_m_grid(gaps(s), cfg),
        "k_m_table": lambda s: ST.k_m_pivot(s["k_m_grid"]),
        "best_window": lambda s: ST.best_window(s["window_sweep"]),
        "dormancy_length": lambda s: ST.dormancy_length_dist(gaps(s), cfg),
        "return_rates": lambda s: ST.return_rates(orders, cfg),
        "monthly_volume": lambda s: ST.monthly_volume(orders, cfg),
    }, {
        "gaps": lambda: ST.study_gaps(orders, cfg),
        "unique": lambda: TL.unique_orders(TL.valid_purchases(orders, cfg)),
        "day_gaps": lambda: TL.purchase_gaps(TL.daily_timeline(TL.valid_purchases(orders, cfg))),
    })
