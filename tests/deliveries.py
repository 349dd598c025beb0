"""Deliveries for tests: rows of a site, and a landing folder that tests can damage."""

import csv
from pathlib import Path

from batchgate.operators.contract import DEFAULT

DAY = "2026-09-25"


def sample_rows(site, count=40, dirty=True, day=DAY):
    text = day if site == "A" else day.replace("-", "/")
    value, unit = ("90", "mg/dL") if site == "A" else ("5", "mmol/L")
    rows = [
        dict(zip(DEFAULT.columns, [
            f"SYN-P-{i // 2}", "1980", f"SYN-V-{i}", text, f"SYN-M-{i}", text, "DEMO_GLU", value,
            unit]))
        for i in range(count)
    ]
    if dirty:
        first = rows[0]
        rows += [dict(first), dict(first, patient_id=""),
                 dict(first, measurement_date="2026-02-30"), dict(first, unit="unknown")]
    return rows


class Landing:
    """A delivery folder that tests can damage; files as a sender would write them."""

    def __init__(self, path: Path):
        self.path = path
        path.mkdir(parents=True, exist_ok=True)

    def file(self, site):
        return self.path / f"hospital_{site}.csv"

    def control(self, site):
        return self.path / f"hospital_{site}.rows"

    def write(self, site, rows, control=True):
        with self.file(site).open("w", newline="", encoding="utf-8") as stream:
            writer = csv.DictWriter(stream, fieldnames=DEFAULT.columns)
            writer.writeheader()
            writer.writerows(rows)
        if control:
            self.control(site).write_text(f"{len(rows)}\n", encoding="ascii")

    def append(self, site, text, rows):
        with self.file(site).open("a", newline="", encoding="utf-8") as stream:
            stream.write(text)
        self.control(site).write_text(f"{rows}\n", encoding="ascii")

    def fill(self, count=40, dirty=True, day=DAY):
        for site in DEFAULT.sites:
            self.write(site, sample_rows(site, count, dirty, day))
        return self

    def __str__(self):
        return str(self.path)
