"""Gold layer: daily, monthly and quarterly rollups of the silver core (M5-M7)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickfold.functions.time import GRAINS, coarser_or_equal
from tickfold.operators.rollup import coarsen, finish, period_state

GOLD_GRAINS = ("day", "month", "quarter")


def rollup(core_rows: DataFrame, companies: DataFrame, grain: str, sort: bool = True) -> DataFrame:
    """One gold report at ``grain`` straight from the silver core."""
    return finish(period_state(core_rows, grain), companies, grain, sort)


def rollup_from_state(state: DataFrame, state_grain: str, companies: DataFrame, grain: str,
                      sort: bool = True) -> DataFrame:
    """A gold report at ``grain`` from a state at a finer or equal grain."""
    if not coarser_or_equal(state_grain, grain):
        raise ValueError(f"cannot roll {state_grain} state down to {grain}")
    if grain != state_grain:
        state = coarsen(state, grain)
    return finish(state, companies, grain, sort)


def rollups(core_rows: DataFrame, companies: DataFrame, grains=GOLD_GRAINS,
            sort: bool = True) -> dict[str, DataFrame]:
    """All gold reports, each built from the finest requested grain's state."""
    finest = min(grains, key=GRAINS.index)
    state = period_state(core_rows, finest)
    return {g: rollup_from_state(state, finest, companies, g, sort) for g in grains}
