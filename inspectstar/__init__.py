"""Star-schema builds over flat inspection records, expressed as Spark jobs."""
