"""fieldstack: set-at-a-time preparation of multi-date satellite field stacks on Spark.

Every public function maps DataFrames to DataFrames; nothing runs until a sink or an
action is called, so Catalyst sees each whole plan.
"""

from fieldstack.session import get_session, checkpoint_dir, materialize

__all__ = ["get_session", "checkpoint_dir", "materialize"]
