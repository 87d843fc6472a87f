"""Operators by name, and lists of them as data: a job is a sequence of (name, parameters)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from hostscope.operators import baselines, deviation, gram, item_windows, novelty, packed, permutation, prep, quality, ranges, selection, sketches, slices, windows

OPERATORS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (
        quality.map_fields, quality.drop_empty, quality.with_duration, quality.null_negative, quality.in_slice, quality.clean, quality.drop_malformed_ips, quality.rename_legacy,
        slices.stamp_slice, slices.stamp_fixed_slice, slices.role_views, slices.burst, slices.slice_metrics, slices.pair_context, slices.pair_counts,
        windows.in_windows, windows.window_sums, windows.with_ratios, windows.pair_windows, windows.rolling, windows.wide_by_role, windows.long_by_role, windows.stamp,
        baselines.anomaly_weights, baselines.long_metrics, baselines.baselines, baselines.pair_rarity, deviation.transforms, deviation.scores, deviation.rarity_weighted,
        baselines.with_any_prefix, selection.quantiles, selection.discrete, sketches.metric_sketches, sketches.daily_sketches, sketches.merged, sketches.sketched_baselines,
        item_windows.slice_items, item_windows.window_items, item_windows.advance, item_windows.window_shapes, item_windows.slice_distincts, item_windows.window_distincts,
        novelty.lookback, novelty.novelty, novelty.high_risk_segments, novelty.day_ring, novelty.advance_ring, novelty.ring_lookback,
        packed.pack, packed.packed_statistics, packed.route, packed.group_scores, permutation.permuted, gram.correlations,
        prep.fit_scaling, prep.apply_scaling, prep.varying_features, prep.stable_features, prep.score_metrics, prep.gates, ranges.numbered,
    )
}


@dataclass(frozen=True)
class OperatorSpec:
    """One step: an operator's name and its parameters beside the table."""

    type: str
    params: Mapping[str, object] = field(default_factory=dict)


def apply(df: DataFrame, steps: Sequence[OperatorSpec]) -> DataFrame:
    """The table after all steps, in order; an unknown name raises before any step is taken."""
    if unknown := [s.type for s in steps if s.type not in OPERATORS]:
        raise ValueError(f"no operator is named {', '.join(unknown)}")
    for s in steps:
        df = OPERATORS[s.type](df, **s.params)
    return df
