"""dialoom: Spark-first building, sampling, auditing and upkeep of dialogue datasets."""
