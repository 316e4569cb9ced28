"""fleetlens: urban-mobility analytics as Spark DataFrame functions."""
