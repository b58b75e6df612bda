"""Structured Streaming scorer."""
from .scoring import stream_score  # noqa: F401
