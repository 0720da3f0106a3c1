"""raremine: Spark-native operators for finding a rare class in keyed, messy
tables and labelled text.

Every operator is a function ``DataFrame -> DataFrame`` (or returns a small
driver-side object whose size depends on the number of columns, never on the
number of rows).  Randomness is derived from ``md5`` of explicit keys so that
results do not depend on partitioning or on the number of executors.
"""

SEED = 42

__all__ = ["SEED"]
