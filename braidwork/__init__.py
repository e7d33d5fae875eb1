"""braidwork: payload reconciliation, reporting and corpus preparation as Spark jobs."""
