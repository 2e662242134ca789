"""pastline: past-only analytics over dated two-sided contests, on Spark.

Every public operator is ``f(df, *, params) -> DataFrame`` (or an
estimator/model pair when it has fitted state). Operators build lazy plans;
only fitting and iterative algorithms run actions.
"""

__version__ = "0.1.0"
