"""Structured Streaming jobs that keep the ODS tables current."""
