"""placeloom: Spark-first analytics over place and venue records."""
