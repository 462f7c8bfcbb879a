"""Spark-native store snapshot analytics: normalise, identify, deduplicate, diff and report."""
