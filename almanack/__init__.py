"""Monthly statistics pipeline on Spark: raw documents, typed snapshots,
a dimensional model, comparison marts, profiling and publication."""
