"""Claims revenue-cycle analytics expressed as Spark DataFrame jobs."""
