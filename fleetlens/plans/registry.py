"""All registered queries of the library."""

from fleetlens.plans import assembly_queries, base_queries, change_queries, decision_queries, decompose_queries, detail_queries, document_queries, explain_queries, forecast_queries, incremental_queries, layout_queries, predict_queries, prediction_queries, stretch_queries, timed_queries  # noqa: F401
from fleetlens.plans.registration import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
