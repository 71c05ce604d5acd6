"""Plans: the five-step pipeline, the query catalog and its oracle SQL."""

from strata.plans.pipeline import Layers, run_pipeline  # noqa: F401
