"""Spark-native analytics over hazard events, change feeds and supply-chain text."""
