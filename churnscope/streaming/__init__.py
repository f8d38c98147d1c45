"""Structured Streaming forms of the analysis."""

from churnscope.streaming.early_warning import alerts, current_alerts, replay

__all__ = ["alerts", "current_alerts", "replay"]
