"""Customer-behaviour analytics on Spark: raw tables to a point-in-time panel, models and scores."""
