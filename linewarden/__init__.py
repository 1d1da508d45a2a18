"""Network-outage analytics as PySpark DataFrame jobs."""
