"""Transaction-fraud analytics on Spark: decode, clean, featurise, flag, train, score.

Every function takes and returns a ``DataFrame`` (or builds a ``Column``, an option map or
a fitted model); nothing here pulls rows to the driver beyond counts, thresholds and metrics.
"""

__version__ = "0.1.0"
