"""Rule registry: SQL boolean expressions by name, grouped by source."""

from __future__ import annotations

from collections.abc import Iterable, Mapping


class RuleBook:
    """Rules by source tag; each rule is a name and a SQL boolean expression."""

    def __init__(self) -> None:
        self._rules: dict[str, dict[str, str]] = {}

    def add(self, tag: str, name: str, constraint: str) -> RuleBook:
        """Register one rule; a name may be used once per tag."""
        rules = self._rules.setdefault(tag, {})
        if name in rules:
            raise ValueError(f"rule {name!r} is already registered for {tag!r}")
        rules[name] = constraint
        return self

    def add_all(self, tag: str, rules: Mapping[str, str] | Iterable[tuple[str, str]]) -> RuleBook:
        for name, constraint in rules.items() if isinstance(rules, Mapping) else rules:
            self.add(tag, name, constraint)
        return self

    @property
    def tags(self) -> list[str]:
        return sorted(self._rules)

    def rules_for(self, tag: str) -> dict[str, str]:
        """Rules of one tag in registration order."""
        if tag not in self._rules:
            raise ValueError(f"unknown tag {tag!r}; known: {self.tags}")
        return dict(self._rules[tag])
