"""Customer retention and recurring-revenue analytics, written as Spark DataFrame jobs."""
