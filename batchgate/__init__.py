"""Gated publishing of daily snapshots with Spark DataFrames."""

from batchgate.errors import BatchError
from batchgate.functions.tokens import DEMO_KEY
from batchgate.operators.contract import Contract
from batchgate.plans.batch import run_batch
from batchgate.plans.daily import audit, compare_paths, run_daily
from batchgate.plans.store import digest_snapshot, quarantine_rows, runs, snapshot
from batchgate.sources.landing import input_fingerprint
from batchgate.sources.normalise import land
from batchgate.sources.synthetic import generate

__all__ = [
    "BatchError", "Contract", "DEMO_KEY", "audit", "compare_paths", "digest_snapshot", "generate",
    "input_fingerprint", "land", "quarantine_rows", "run_batch", "run_daily", "runs", "snapshot",
]
