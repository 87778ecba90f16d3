"""Rules and packs: what they are called, what they read, and how they are expressed."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERY = "input_msg_content"
ANSWER = "output_msg_content"
SEARCH_QUERY = "search_query"
RETRIEVED_DOCS = "retrieved_docs"


@dataclass(frozen=True)
class Rule:
    """``build`` takes the pack's prepared columns by name and gives a boolean that is never null."""

    name: str
    reads: tuple[str, ...]
    build: Callable[[dict[str, Column]], Column]


@dataclass(frozen=True)
class Pack:
    """Rules over common intermediate columns.

    ``prepare`` gives steps of named columns over the raw ones; each step is a
    projection of its own, so that what rules share is computed once.
    """

    name: str
    rules: tuple[Rule, ...]
    prepare: Callable[[dict[str, Column]], list[dict[str, Column]]]
    optional: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        seen: set[str] = set()
        for rule in self.rules:
            if rule.name in seen:
                raise KeyError(f"two rules are named {rule.name}")
            seen.add(rule.name)

    def with_rule(self, rule: Rule) -> Pack:
        """The pack with one more rule."""
        return Pack(self.name, (*self.rules, rule), self.prepare, self.optional)

    def names(self) -> list[str]:
        return [r.name for r in self.rules]

    def present(self, columns: Iterable[str]) -> list[Rule]:
        """The rules whose optional columns are there."""
        have = set(columns)
        return [r for r in self.rules if not any(c in self.optional and c not in have for c in r.reads)]

    def hits(self, df: DataFrame, only: Iterable[str] | None = None) -> DataFrame:
        """``df`` with a boolean column for each rule; null where a rule's column is absent."""
        raw = {c: F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string") for c in (QUERY, ANSWER, SEARCH_QUERY, RETRIEVED_DOCS)}
        columns = list(df.columns)
        wanted = [r for r in self.rules if only is None or r.name in set(only)]
        out, made = df, dict(raw)
        steps = self.prepare(raw)
        for i, step in enumerate(steps):
            step = step(made) if callable(step) else step
            for name, value in step.items():
                made[name] = F.col(f"`__{name}`")
            out = out.select("*", *[value.alias(f"__{name}") for name, value in step.items()])
        there = {r.name for r in self.present(columns)}
        flags = [(r.build(made) if r.name in there else F.lit(None).cast("boolean")).alias(r.name) for r in wanted]
        return out.select(*[F.col(f"`{c}`") for c in columns], *flags)
