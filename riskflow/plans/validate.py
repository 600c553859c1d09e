"""Validation as a job: the report as an object, and the strict mode that raises."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskflow.contract import CONTRACT, Contract
from riskflow.operators.quality import EMPTY, EMPTY_MESSAGE, ERROR, REJECT, report
from riskflow.operators.quality_state import Ledger


class DataValidationError(Exception):
    """A strict validation failed; ``report`` says why."""

    def __init__(self, message: str, report: dict):
        super().__init__(message)
        self.report = report


def empty_report() -> dict:
    issue = {"field": "Dataset", "error_type": EMPTY, "message": EMPTY_MESSAGE, "severity": ERROR,
             "invalid_rows_count": 0, "sample_invalid_values": []}
    return {"is_valid": False, "total_records": 0, "error_count": 1, "warning_count": 0,
            "action_taken": REJECT, "errors": [issue], "warnings": []}


def validate(df: DataFrame | None, contract: Contract = CONTRACT, dataset_type: str = "auto",
             training: bool = False, strict: bool = True, order: list[str] | None = None) -> dict:
    """Check a table and give the report, whose size does not depend on the table's.

    The table is read once: counters and offending cells come from the same pass. In strict mode an invalid table raises.
    """
    if df is None or not df.columns:
        found = empty_report()
    else:
        found = report(df, contract, dataset_type, training, strict, order).first().asDict(True)
    return _strictly(found) if strict else found


def validate_growing(df: DataFrame, part: str, ledger: str, contract: Contract = CONTRACT, dataset_type: str = "auto",
                     training: bool = False, strict: bool = True, order: list[str] | None = None) -> dict:
    """The report of a table that grows by partitions: only those that ``ledger`` has no state of yet are read.

    ``part`` is the table's partition column; a part that was changed since must be dropped from the ledger (``Ledger.forget``).
    """
    book = Ledger(df.sparkSession, ledger, contract, dataset_type, training)
    book.update(df, part, order)
    found = book.report(df.drop(part), strict).first().asDict(True)
    return _strictly(found) if strict else found


def _strictly(found: dict) -> dict:
    if not found["is_valid"]:
        reasons = "; ".join(e["message"] for e in found["errors"])
        raise DataValidationError(f"validation failed with {found['error_count']} error(s): {reasons}", found)
    return found
