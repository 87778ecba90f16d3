"""The run summary, as text.

A summary is a list of facts between two rules; a fact is a label, a value and
the lines that belong to it. The frame, labels and order are a fixed layout.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from unicodedata import east_asian_width

from pyspark.sql import Row

FRAME = 45
_LABEL, _METRIC = 10, 23


def display_width(text: str) -> int:
    """Columns on a terminal, where wide characters take two."""
    wide = [c for c in text if east_asian_width(c) in "WF"]
    return len(text) + len(wide)


@dataclass(frozen=True)
class Fact:
    label: str
    value: str = ""
    below: Sequence[str] = ()

    def lines(self) -> Iterator[str]:
        yield f"{self.label:<{_LABEL}}: {self.value}".rstrip()
        yield from (f"  {line}" for line in self.below)


@dataclass(frozen=True)
class Summary:
    """What one run found. ``metrics``: rule name to ``hits / rows``."""

    version: str
    args: str
    source: str
    rows: int
    columns: int
    violations: Sequence[str] = ()
    notes: Sequence[str] = ()
    metrics: dict[str, str] = field(default_factory=dict)
    seconds: float = 0.0
    peak_bytes: int = 0

    @property
    def status(self) -> str:
        return "CONTRACT MISMATCH" if self.violations else "OK"

    def facts(self) -> Iterator[Fact]:
        bad = len(self.violations)
        yield Fact("version", self.version)
        yield Fact("args", self.args)
        yield Fact("input", self.source)
        yield Fact("shape", f"{self.rows:,} rows x {self.columns} cols")
        yield Fact("schema", f"{max(self.columns - bad, 0)} ok / {bad} MISMATCH", [f"- {v}" for v in self.violations])
        if self.notes:
            yield Fact("notes", f"{len(self.notes)} (판정에 영향 없음)", [f"- {n}" for n in self.notes])
        yield Fact("metrics", below=[name + " " * (_METRIC - display_width(name)) + f" {value}" for name, value in self.metrics.items()])
        yield Fact("runtime", f"{self.seconds:.1f}s, peak {self.peak_bytes / 2**30:.2f}GB")
        yield Fact("status", self.status)

    def text(self) -> str:
        rule = "=" * FRAME
        body = [line for fact in self.facts() for line in fact.lines()]
        return "\n".join([rule, f"{'RUN SUMMARY':^{FRAME}}", rule, *body, rule])


def tag_lines(counts: Sequence[Row]) -> list[str]:
    """A line for each row (tag, n, pct)."""
    wide = max((len(r.tag) for r in counts), default=0)
    return [f"{r.tag:<{wide}}  {r.n:>10,} ({r.pct:.2f}%)" for r in counts]
