"""Composed tables: staging to ODS, ODS to reporting marts."""
