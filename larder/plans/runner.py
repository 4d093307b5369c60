"""Run named steps so that one failure does not stop the others."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

log = logging.getLogger(__name__)


@dataclass
class RunReport:
    results: dict[str, Any] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return not self.errors

    def raise_on_error(self) -> "RunReport":
        if self.errors:
            raise RuntimeError(f"failed steps: {self.errors}")
        return self


def run_steps(steps: Mapping[str, Callable[[], Any]], only: Iterable[str] | None = None) -> RunReport:
    """Run all steps, or those named in ``only``, and collect results and errors."""
    chosen = list(steps) if only is None else list(only)
    unknown = [name for name in chosen if name not in steps]
    if unknown:
        raise ValueError(f"unknown steps: {unknown}")
    report = RunReport()
    for name in chosen:
        try:
            report.results[name] = steps[name]()
        except Exception as error:
            log.exception("step %s failed", name)
            report.errors[name] = str(error)
    return report
