"""Batch and streaming operators; every one maps a DataFrame to a DataFrame."""
