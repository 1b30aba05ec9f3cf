"""Readers: task logs, schedules, directory listings and row-count scans."""

from laketally.sources.listing import list_files
from laketally.sources.scans import scan_row_counts
from laketally.sources.schedules import (
    all_task_names,
    config_violations,
    read_schedules,
    read_templates,
    schedule_by_task,
    schedule_tables,
    schedules_from_dicts,
    variables_from_dicts,
)
from laketally.sources.task_log import read_task_log, task_log_distinct, task_log_window

__all__ = [
    "all_task_names",
    "config_violations",
    "list_files",
    "read_schedules",
    "read_task_log",
    "read_templates",
    "scan_row_counts",
    "schedule_by_task",
    "schedule_tables",
    "schedules_from_dicts",
    "task_log_distinct",
    "task_log_window",
    "variables_from_dicts",
]
