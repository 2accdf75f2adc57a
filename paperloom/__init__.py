"""paperloom: a Spark-native engine for scholarly metadata and document corpora."""
