"""lacuna: missing-data analytics on Spark.

Fit/transform imputers, holdout masks and scoring, all expressed as Spark
DataFrame plans (aggregates, windows, joins) so the work scales with the
cluster rather than with one machine.
"""

from lacuna.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
