"""Spark-native analytics over position-keyed data: reads, pileups, calls, intervals and generic ordered tables."""
