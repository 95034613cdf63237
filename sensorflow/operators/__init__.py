"""Transforms from DataFrame to DataFrame. They run no action and accept tables and streams."""
