"""churnscope — customer value and churn analytics as Spark DataFrame jobs.

Every public operator takes and returns a lazy ``DataFrame``; nothing is
collected to the driver except bounded, size-checked scalars (for example
the per-partition row counts of the distributed rank, one row per shuffle
partition).
"""

from churnscope.config import Params

__all__ = ["Params"]
__version__ = "0.1.0"
