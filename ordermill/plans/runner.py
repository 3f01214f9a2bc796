"""Run the report suite: every query of every domain, one CSV result each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ordermill.plans.kpis import DOMAINS
from ordermill.sources.files import write_report


class ReportError(RuntimeError):
    """Some queries failed; the others have been written. ``failures`` maps query to error."""

    def __init__(self, failures: dict[str, Exception]):
        super().__init__("; ".join(f"{name}: {error}" for name, error in failures.items()))
        self.failures = failures


def run_reports(
    tables, out_dir: str, domains: dict[str, dict[str, Callable[..., DataFrame]]] = DOMAINS
) -> list[str]:
    """Write ``out_dir/<domain>/<query>``; a failed query does not stop the rest.

    Returns the queries written; raises ``ReportError`` at the end if any failed.
    """
    written, failures = [], {}
    for domain, queries in domains.items():
        for name, query in queries.items():
            try:
                write_report(query(tables), f"{out_dir}/{domain}/{name}")
                written.append(f"{domain}/{name}")
            except Exception as error:  # reported together at the end
                failures[f"{domain}/{name}"] = error
    if failures:
        raise ReportError(failures)
    return written
