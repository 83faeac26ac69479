"""commitloom: version-control history to curated training data, as Spark plans."""
