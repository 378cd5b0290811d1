"""Vehicle-trajectory analytics expressed as Spark DataFrame jobs."""

from trailframe.plans.pipeline import Options, run

__all__ = ["Options", "run"]
