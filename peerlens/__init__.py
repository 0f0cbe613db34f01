"""peerlens — dual-program billing analytics on Spark.

Two claim sources are landed, cleaned and rolled up to a common
provider x procedure grain, joined, gated on data-quality checks and
turned into three marts (provider spending, specialty utilisation, peer
outlier indicators) that five ranked reports read.

Every operator is a plain function from DataFrames to DataFrames; all
work runs inside Spark (Catalyst + whole-stage codegen), with no Python
UDFs in the data path.
"""

from peerlens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
