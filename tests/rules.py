"""The rules once more in plain Python, to compare random inputs against."""

import re


def batch_parts(batch_no, period_type):
    if not batch_no:
        return None, None, None
    d = re.sub("[^0-9]", "", batch_no)
    n = len(d)
    wanted = {"hourly": 10, "daily": 8, "monthly": 6}.get(period_type)
    used = wanted if wanted and n >= wanted else 10 if n >= 10 else n if n in (8, 6) else 0
    return (
        d[:8] if used >= 8 else None,
        d[:6] if used >= 6 else None,
        d[8:10] if used == 10 else None,
    )


def text_rows(data: bytes, delimiter: bytes) -> int:
    if not data:
        return 0
    starts = sum(data.startswith(delimiter, i) for i in range(len(data)))
    return starts + (not data.endswith(delimiter))


def default_date(period, today):
    import datetime as dt

    if period in ("hourly", "minutely"):
        day = today
    elif period == "monthly":
        day = today.replace(day=1) - dt.timedelta(days=1)
    else:
        day = today - dt.timedelta(days=1)
    return day.strftime("%Y%m%d")


def job_dates(period, parts, today):
    day, month, hour = parts
    default = default_date(period, today)
    if period == "monthly":
        return None, month or default[:6], hour
    if not day:
        day, month = default, default[:6]
    return day, month, hour


def rendered(base, template, dates):
    if not template:
        return base
    day, month, hour = dates
    month = month or (day[:6] if day else None)
    for name, value in (("data_date", day), ("data_month", month), ("data_hour", hour)):
        if value:
            template = template.replace("${%s}" % name, value)
    return base.rstrip("/") + "/" + template.lstrip("/")


def jobs(schedules, log, today):
    """(task, batch, table, path, format, dates) of every job that can run."""
    first = {}
    for task, period, batch, state, at in sorted(log, key=lambda r: r[4]):
        if state == 1:
            first.setdefault((task, batch or ""), period or "daily")
    for s in schedules:
        period = s.get("period_type") or "daily"
        for (task, batch), log_period in first.items():
            if task != s["task_name"] or log_period != period:
                continue
            dates = job_dates(period, batch_parts(batch, log_period), today)
            for t in s["tables"]:
                path = rendered(t["hdfs_path"], t.get("partition_template"), dates)
                if "${" not in path:
                    yield task, batch, t["name"], path, t["format"].lower(), dates
