"""Area-risk analytics on PySpark.

Indicator tables at several geographic levels are cleaned, rolled up through
area hierarchies, classified, combined into worst-of scores and summarised.
Every step is a DataFrame plan; see README.md for the map of modules.
"""
