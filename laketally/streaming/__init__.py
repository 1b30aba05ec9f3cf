"""The audit as a Structured Streaming query."""

from laketally.streaming.audit_stream import (
    audit_stream,
    completed_task_stream,
    first_completions,
    task_history_stream,
)

__all__ = ["audit_stream", "completed_task_stream", "first_completions", "task_history_stream"]
