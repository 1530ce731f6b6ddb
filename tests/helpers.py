"""Small fixture builders for unit tests (tiny, explicit frames)."""

from __future__ import annotations

import datetime as dt
import json
import os
from decimal import Decimal

from ratelake.settings import Settings

OBS_SCHEMA = "series_id int, series_name string, granularity string, ref_date date, year_month string, value decimal(18,8)"


def obs_rows(months: int = 24, days: int = 20, daily: str = "0.05", monthly: str = "0.40", start=(2020, 1)):
    """``months`` complete months: ``days`` daily policy rows + 1 monthly row each."""
    rows = []
    y, m = start
    for _ in range(months):
        ym = f"{y:04d}-{m:02d}"
        for d in range(1, days + 1):
            rows.append((11, "selic", "diaria", dt.date(y, m, d), ym, Decimal(daily)))
        rows.append((433, "ipca", "mensal", dt.date(y, m, 1), ym, Decimal(monthly)))
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return rows


def settings_for(root: str, months: int = 24, start: str = "2020-01", **kw) -> Settings:
    y, m = (int(p) for p in start.split("-"))
    total = y * 12 + (m - 1) + months - 1
    last = f"{total // 12:04d}-{total % 12 + 1:02d}"
    return Settings(root=root, first_month=start, last_month=last, **kw)


def write_json(path: str, payload, pretty: bool = True) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        if isinstance(payload, str):
            f.write(payload)
        else:
            f.write(json.dumps(payload, ensure_ascii=False, indent=2 if pretty else None))


def series_payload(months: int = 24, days: int = 20, daily: str = "0.05", monthly: str = "0.40", start=(2020, 1)):
    sel, ipc = [], []
    y, m = start
    for _ in range(months):
        for d in range(1, days + 1):
            sel.append({"data": f"{d:02d}/{m:02d}/{y:04d}", "valor": daily})
        ipc.append({"data": f"01/{m:02d}/{y:04d}", "valor": monthly})
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return sel, ipc
