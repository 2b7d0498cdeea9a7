"""Gold marts, checks, profiles and chart aggregates for an e-commerce star schema on Spark."""

from starmill.plans.registry import MartSpec, build, mart_names, spec
from starmill.session import configure, scratch_dir

__all__ = ["MartSpec", "build", "configure", "mart_names", "scratch_dir", "spec"]
