"""Sensor-data pipelines on Spark tables and streams."""
