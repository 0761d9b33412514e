"""starlane: star-schema ETL and KPI queries as Spark DataFrame jobs."""

__version__ = "0.1.0"
