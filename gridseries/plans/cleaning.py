"""The whole cleaning run: profile, fill, dedup, standardize, outliers, encode, scale, validate."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridseries.operators.duplicates import remove_duplicates
from gridseries.operators.encoding import apply_labels, encodable_columns, fit_categories, fitted_columns
from gridseries.operators.infinite import handle_infinite, infinite_columns, infinity_metrics
from gridseries.operators.missing import fill_missing
from gridseries.operators.ordered import BLOCK_ROWS
from gridseries.operators.outliers import QUARTILES, detect_outliers, measured_columns, treat_outliers
from gridseries.operators.profile import describe, quality_profile, validation_report
from gridseries.operators.quantiles import brackets
from gridseries.operators.scaling import scale_features
from gridseries.operators.standardize import standardize_format
from gridseries.plans.artifacts import Fitted, save_artifacts
from gridseries.session import materialize, materialize_observed


def profile(df: DataFrame) -> dict:
    return quality_profile(df) | {"data_types": {f.name: f.dataType.simpleString() for f in df.schema}}


def clean(df: DataFrame, fitted: Fitted | None = None, scale_method: str = "standard",
          handle_outliers: bool = True, outlier_method: str = "clip", order_by: list[str] | None = None,
          artifacts_folder: str | None = None, with_report: bool = True, exact: bool = True,
          null_token: str | None = None, block_rows: int | None = BLOCK_ROWS) -> tuple[DataFrame, Fitted]:
    """Without ``fitted`` this trains: outliers are treated, encoder and scaler are fitted and saved.

    With ``fitted`` the stored encoder and scaler are applied. The table is written to the shared folder
    after standardizing, and before infinities are handled where there are any: the steps behind each
    read it several times, and from there a lost executor costs a scan instead of all windows before it.
    What the next step asks of a stored table first is observed while it is written.
    """
    training = fitted is None
    result = Fitted() if training else Fitted(fitted.scaler, fitted.categories)
    report = result.report
    if with_report:
        report["quality"] = profile(df)
    finite = fill_missing(df, "smart", order_by, exact=exact, block_rows=block_rows)
    # Finite values interpolate to finite ones, so a table without infinities can skip the step.
    if report["quality"]["inf_values"] if with_report else infinite_columns(df):
        filled, seen = materialize_observed(finite, "filled", infinity_metrics(finite, "replace", exact))
        finite = handle_infinite(filled, "replace", exact, seen)
    uniform = standardize_format(remove_duplicates(finite), null_token=null_token)
    treating = handle_outliers and training
    frame, seen = materialize_observed(
        uniform, "uniform", brackets(measured_columns(uniform), QUARTILES) if treating and exact else [])

    if treating:
        found = detect_outliers(frame, "iqr", 3.0, exact=exact, seen=seen)
        report["outliers"] = {"method": "iqr", "threshold": 3.0, "columns": {
            o.column: {"count": o.count, "percent": o.percent, "lower_bound": o.lower, "upper_bound": o.upper}
            for o in found}}
        if found:
            frame = treat_outliers(frame, outlier_method, found)

    columns = encodable_columns(frame)
    if columns and training:
        result.categories = materialize(fit_categories(frame, columns, null_token), "categories")
    elif columns:
        _require_fitted(frame, columns, result.categories)
    if columns:
        frame = apply_labels(frame, result.categories, columns, null_token)
        report["encoding"] = {"method": "label", "columns": columns}

    if not training and result.scaler is None:
        raise ValueError("the scaler was never fitted")
    frame, result.scaler = scale_features(frame, scale_method, scaler=result.scaler)
    report["scaling"] = {"method": scale_method, "columns": list(result.scaler.centers)}

    if with_report:
        report["validation"] = validation_report(frame).first().asDict()
        report["validation"]["statistics"] = {r["column"]: r.asDict() for r in describe(frame, exact=exact).collect()}
    if training and artifacts_folder:
        save_artifacts(df.sparkSession, result, artifacts_folder)
    return frame, result


def _require_fitted(frame: DataFrame, columns: list[str], categories: DataFrame | None) -> None:
    """Only columns without any value may lack categories."""
    unfitted = set(columns) - set(fitted_columns(categories) if categories is not None else [])
    if unfitted and frame.select(*unfitted).dropna("all").limit(1).count():
        raise ValueError(f"the encoder was never fitted for {sorted(unfitted)}")
