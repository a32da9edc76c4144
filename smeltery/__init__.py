"""Daily retail batches refined from raw files to gold tables on Spark."""
