"""tablelearn: keyed, deterministic learning-pipeline operators on Spark DataFrames.

DataFrame in, DataFrame out.  Every operator takes the key column it must
respect, fitted state is a small DataFrame or a Spark ML model, and no
operator pulls data-sized results to the driver.
"""

from tablelearn.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
