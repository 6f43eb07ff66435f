"""The corpus pipeline: its stages, their run, and its SQL (none)."""

from forgeline.llm.pipeline import ORACLE_SQL, STAGES, run  # noqa: F401
