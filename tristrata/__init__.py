"""Layered (Bronze, Silver, Gold) analytics as plain PySpark DataFrame functions."""
