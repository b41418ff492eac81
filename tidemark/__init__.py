"""Layered analytics tables on PySpark: raw -> bronze -> silver -> gold, batch and streaming."""
