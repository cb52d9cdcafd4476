"""skyledger: air-traffic data quality and star-schema loads as Spark jobs."""

__version__ = "0.1.0"
