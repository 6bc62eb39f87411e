"""Helpers of the tests: a small object store of billing deliveries."""

from __future__ import annotations

import gzip
import json
from pathlib import Path

from billweave.operators.table import BillingTable
from billweave.plans.run import Places

BASE = [
    ("identity", "LineItemId", "String"),
    ("bill", "BillingPeriodStartDate", "DateTime"),
    ("bill", "BillingPeriodEndDate", "DateTime"),
    ("lineItem", "UsageStartDate", "DateTime"),
    ("lineItem", "UsageAccountId", "String"),
    ("lineItem", "ProductCode", "String"),
    ("lineItem", "UnblendedCost", "BigDecimal"),
]


class Cloud:
    """A small object store with manifests and staged parts, for one test."""

    def __init__(self, spark, root: Path, prefix="bills/main", export="daily.usage", version="v2"):
        self.spark, self.root = spark, root
        self.prefix, self.export, self.version = prefix, export, version

    def folder(self, name: str) -> str:
        return str(self.root / name)

    @property
    def places(self) -> Places:
        return Places(
            self.folder("store"), self.prefix, self.export, self.version, self.folder("staging"),
            self.folder("table"), self.folder("exports"), self.folder("warehouse"),
        )

    @property
    def scan(self) -> tuple:
        return self.folder("store"), self.prefix, self.export, self.version

    @property
    def table(self) -> BillingTable:
        return BillingTable(self.spark, self.folder("table"))

    @property
    def warehouse(self) -> BillingTable:
        return BillingTable(self.spark, self.folder("warehouse"))

    def manifest(self, period: str, execution: str, files=(), columns=BASE, text=None, folder=None, **changes):
        compact = period.replace("-", "") + "01"
        later = "20991201" if self.version == "v1" else ""
        place = folder or (f"{compact}-{later}" if self.version == "v1" else f"metadata/BILLING_PERIOD={period}")
        record = {
            "assemblyId": execution,
            "executionId": execution,
            "billingPeriod": {"start": f"{compact}T000000.000Z", "end": "x"},
            "reportKeys": [f"{self.prefix}/{period}/{f}" for f in files],
            "columns": [{"category": c, "name": n, "type": t} for c, n, t in columns or []] or None,
            "compression": "GZIP",
        } | changes
        record = {k: v for k, v in record.items() if v is not None}
        path = self.root / "store" / self.prefix / self.export / place / f"{self.export}-Manifest.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text if text is not None else json.dumps(record, indent=2))

    def part(self, period: str, execution: str, name: str, text: str):
        path = self.root / "staging" / period / execution / name
        path.parent.mkdir(parents=True, exist_ok=True)
        data = text.encode()
        path.write_bytes(gzip.compress(data) if name.endswith(".gz") else data)

    def delivery(self, period: str, execution: str, ids, cost="1.25", columns=BASE, name="part-0.csv.gz", extra=(), **changes):
        """One complete delivery with a row per id."""
        self.part(period, execution, name, csv_text(period, ids, cost, columns, extra))
        self.manifest(period, execution, [name], columns, **changes)


def csv_text(period: str, ids, cost="1.25", columns=BASE, extra=()) -> str:
    values = {
        "LineItemId": None,
        "BillingPeriodStartDate": f"{period}-01T00:00:00Z",
        "BillingPeriodEndDate": f"{period}-28T00:00:00Z",
        "UsageStartDate": f"{period}-05T00:00:00Z",
        "UsageAccountId": "111",
        "ProductCode": "Store",
        "UnblendedCost": cost,
    } | dict(extra)
    lines = [",".join(f"{c}/{n}" for c, n, _ in columns)]
    lines += [",".join(i if n == "LineItemId" else values[n] for _, n, _ in columns) for i in ids]
    return "\n".join(lines) + "\n"


def rows(frame, *names):
    return sorted(tuple(r) for r in frame.select(*names).collect())
