"""Body-measurement analytics on Spark: curation, quality sensors, mesh measures, scoring, run logs."""
