"""Spark-native analytics for meeting ballots: search, roll-ups, keep-best, linkage, reconciliation, export."""
