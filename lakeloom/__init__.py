"""lakeloom: Spark-native data-processing jobs.

Every operator is a small function ``DataFrame -> DataFrame`` built from
Spark SQL expressions, so Catalyst can push filters and projections into
the scans, plan partial aggregation, and pick join strategies.
"""

__version__ = "0.1.0"
