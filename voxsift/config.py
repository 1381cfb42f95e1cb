"""Tunables of a triage run."""

from __future__ import annotations

from dataclasses import dataclass, field

from . import fixed_values as fv


@dataclass(frozen=True)
class TriageConfig:
    """Settings that reach the plan as literals.

    ``threshold``: items scored below it are skipped (exactly equal passes).
    ``default_priority``: priority per category where nothing better is known.
    ``limit``: number of items to take in intake order; 0 or None means all.
    """

    threshold: float = fv.CONFIDENCE_THRESHOLD
    default_priority: dict[str, str] = field(default_factory=lambda: dict(fv.DEFAULT_PRIORITY))
    limit: int | None = None

    def __post_init__(self) -> None:
        if not 0.0 <= self.threshold <= 1.0:
            raise ValueError("threshold must lie between 0 and 1")
        unknown = set(self.default_priority.values()) - set(fv.PRIORITIES)
        if unknown:
            raise ValueError(f"unknown default priorities: {sorted(unknown)}")
        if self.limit is not None and self.limit < 0:
            raise ValueError("limit must not be negative")
