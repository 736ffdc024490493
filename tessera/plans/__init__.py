"""Registered queries. Importing this package fills the registry."""

from tessera.plans import q_panel, q_eval, q_profile, q_models, q_forecast, q_drift, q_stream, q_extra, q_tests, q_holidays, q_refresh, q_contract  # noqa: F401
from tessera.plans.registry import KIND, ORACLE, QUERIES  # noqa: F401
