"""sievekit — cross-sectional screening and classification on Spark.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions, aggregates, windows and Spark ML.  Fitted statistics
(medians, quantiles, maxima, means) are small DataFrames joined or
scalar-subqueried back into the plan, so a pipeline stays lazy and
distributed until a value genuinely has to reach the driver (a model fit,
a fitted category list).
"""

__version__ = "0.1.0"
