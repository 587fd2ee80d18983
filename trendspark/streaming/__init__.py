"""Structured Streaming forms (T1-T8): hot views, lake archive, warehouse load."""
