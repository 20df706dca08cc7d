"""stratum: medallion (bronze / silver / gold) analytics as Spark DataFrame jobs."""
