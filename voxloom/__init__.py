"""voxloom: Spark-native operators for building speech and language corpora."""
