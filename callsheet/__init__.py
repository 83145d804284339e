"""callsheet — a Spark-native contact-campaign analytics mart.

Raw contact records are staged, segmented by ordered rule tables, rolled up
into a segment dimension and a campaign fact, quality-checked in one
distributed pass, and served as KPI, alert and dashboard-tile DataFrames.
Every function takes and returns DataFrames; nothing is collected.
"""

__all__ = ["fixed", "schema", "session"]
