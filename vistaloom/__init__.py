"""vistaloom: Spark-first curation of posed RGB-D scenes into cross-view training data."""
