"""Purchase analytics on Spark: event conformance, versioned purchases, marts, gates and publication."""
