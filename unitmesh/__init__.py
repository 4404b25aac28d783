"""unitmesh: whole-table operators for facility-registry and routine health reporting data.

Every operator is a function ``DataFrame -> DataFrame`` (or a small bundle of
DataFrames) built from the DataFrame API, so Catalyst plans it and the work is
partitioned across the cluster. Nothing is collected to the driver except
bounded size probes used to decide whether a side may be broadcast.
"""

from unitmesh.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
