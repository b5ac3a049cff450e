"""Climate facts and locations to the master table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridseries.operators.anomalies import PERIOD, anomalies
from gridseries.operators.features import complete_rows, derived_features, lag_features
from gridseries.operators.joins import join_location_metadata
from gridseries.operators.ordered import BLOCK_ROWS


def master_dataset(climate: DataFrame, locations: DataFrame, add_anomalies: bool = True,
                   add_derived: bool = True, add_lags: bool = False,
                   baseline_period: tuple[int, int] = PERIOD, order_by: list[str] | None = None,
                   block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Location metadata, anomalies against the base period, derived features, lags.

    With lags, rows that miss any value are dropped. Rows without a value in the base period have NULL
    anomalies and so would go too: ask for both only where the data covers the period.
    """
    frame = join_location_metadata(climate, locations)
    if add_anomalies and "T2M" in frame.columns:
        frame = anomalies(frame, baseline_period)
    if add_derived:
        frame = derived_features(frame)
    if add_lags:
        frame = complete_rows(lag_features(frame, order_by=order_by, block_rows=block_rows))
    return frame
