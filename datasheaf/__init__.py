"""datasheaf: a Spark-native engine for semi-structured hardware documentation and text corpora."""
