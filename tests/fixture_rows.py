"""A small hand-checked input: two doors over two days, with an empty count, rows out of
order, a reading filed under the wrong day, CRLF and a missing final newline."""

from __future__ import annotations

import datetime as dt

FILES = {
    "north/2024-03-01.csv": (
        "timestamp,in,out\r\n"
        "2024-03-01T07:10:00,4,0\r\n"
        "2024-03-01T09:05:00,2,5\r\n"  # before the 07:40 row
        "2024-03-01T07:40:00,3,\r\n"  # empty out
        "2024-03-01T09:30:00,0,6"  # leaves the day at -2
    ),
    "north/2024-03-02.csv": "timestamp,in,out\n2024-03-02T00:00:00,1,0\n2024-03-02T23:59:59,2,1\n",
    "south/2024-03-01.csv": "timestamp,in,out\n2024-03-01T07:00:00,10,1\n",
    "south/2024-03-02.csv": (
        "timestamp,in,out\n"
        "2024-03-02T12:00:00,5,5\n"
        "2024-03-01T08:15:00,2,3\n"  # belongs to the day before
    ),
}


def _t(day: int, hour: int) -> dt.datetime:
    return dt.datetime(2024, 3, day, hour)


# location, hour, total_in, total_out, net_flow, occupancy
HOURLY = [
    ("north", _t(1, 7), 7, 0, 7, 7),
    ("north", _t(1, 9), 2, 11, -9, -2),
    ("north", _t(2, 0), 1, 0, 1, 1),
    ("north", _t(2, 23), 2, 1, 1, 2),
    ("south", _t(1, 7), 10, 1, 9, 9),
    ("south", _t(1, 8), 2, 3, -1, 8),
    ("south", _t(2, 12), 5, 5, 0, 0),
]

# location, date, total_in, total_out, net_flow
DAILY = [
    ("north", dt.date(2024, 3, 1), 9, 11, -2),
    ("north", dt.date(2024, 3, 2), 3, 1, 2),
    ("south", dt.date(2024, 3, 1), 12, 4, 8),
    ("south", dt.date(2024, 3, 2), 5, 5, 0),
]


def hourly_tuples(df) -> list[tuple]:
    return sorted(
        (r["location"], r["hour"], r["total_in"], r["total_out"], r["net_flow"], r["occupancy"]) for r in df.collect()
    )


def daily_tuples(df) -> list[tuple]:
    return sorted((r["location"], r["date"], r["total_in"], r["total_out"], r["net_flow"]) for r in df.collect())
