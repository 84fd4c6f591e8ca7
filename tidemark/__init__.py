"""tidemark: marketing and product analytics jobs as Spark DataFrame transforms.

Every public job is a function ``DataFrame -> DataFrame`` (plus plain-Python
parameters such as ``as_of`` dates and thresholds).  Jobs never call the wall
clock and never pull data through the driver, except for bounded values: one
scalar, or one row per Spark partition when a global order is numbered.
"""

from tidemark.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
