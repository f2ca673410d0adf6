"""Readers. Every message source ends in a frame with the columns of `schemas.MESSAGE_SCHEMA`."""
