"""panelcast: quarterly panel forecasting on Spark.

Monthly business facts -> quarterly panel with Worldwide totals -> lag/lead
features -> revenue and margin forecasts for several walk-forward origins in
one job -> scored refresh snapshots -> best model per series.

Packages: ``sources`` (table access, the business extracts, the snapshot
store), ``functions`` (calendar and numeric column helpers), ``operators``
(panel, features, stage-2 frames, scoring, selection, model families),
``plans`` (composite runs, the query registry and its DuckDB oracles),
``streaming`` (none needed, see its docstring).
"""

from .plans.params import RunParams  # noqa: F401
