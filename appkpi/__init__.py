"""App KPI analytics on Spark: land report files, type and de-duplicate them, build KPI tables."""
