"""Structured Streaming entry points.

The analysis itself is batch; what runs continuously is serving: new issues arriving as
files are encoded by the fitted feature pipeline (pure Column expressions, so it applies
to a streaming DataFrame unchanged) and scored by the fitted models.
"""

from .score_stream import score_stream

__all__ = ["score_stream"]
