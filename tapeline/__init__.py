"""Daily market data on Spark: landing, merging, load planning, quality reports, instruments and calendar-aligned features."""
