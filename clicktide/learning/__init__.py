"""Feature building, models and evaluation on Spark ML."""
