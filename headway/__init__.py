"""headway: transit-delay analytics written as Spark DataFrame jobs."""
