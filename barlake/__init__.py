"""Market-bar lakehouse jobs on Spark: event log -> bronze -> silver -> gold star -> warehouse."""
