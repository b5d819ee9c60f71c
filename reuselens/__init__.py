"""Spark-native text-reuse analytics: MinHash, TF-IDF, clustering, evaluation."""
