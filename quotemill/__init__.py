"""Spark-native market-microstructure analytics: DataFrame -> DataFrame operators."""
