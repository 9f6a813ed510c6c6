"""Read-only comparison of two copies."""

from __future__ import annotations

from pyspark.sql import DataFrame

from twinproof.operators.counts import TableMap, mismatches, verify_row_counts, verify_summary
from twinproof.operators.scope import Scope


class VerifyFailed(RuntimeError):
    """The copies differ and the mode is strict."""


def verify(source: TableMap, target: TableMap, scope: Scope | None = None, mode: str = "strict") -> DataFrame | None:
    """Count report of both copies. Strict fails on a mismatch, warn prints it, off does nothing.

    Run alone it is strict. The report has one row per table. It is collected once, so that summary, names
    and what is returned are of the same counts.
    """
    if mode == "off":
        return None
    counted = verify_row_counts(source, target, scope)
    report = counted.sparkSession.createDataFrame(counted.collect(), counted.schema)
    summary = verify_summary(report, mode).first()
    if summary["bad"]:
        names = ", ".join(f"{r['schema_name']}.{r['table_name']}" for r in mismatches(report).collect())
        text = f"{summary['message']}: {names}"
        if mode == "strict":
            raise VerifyFailed(text)
        print(text)
    return report
