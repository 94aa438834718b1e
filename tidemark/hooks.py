"""User extension points, all as plain Spark expressions or frame transformations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from .config import CdcConfig
from .operators.columns import matching


@dataclass(frozen=True)
class Hooks:
    """What a user may replace or add.

    ``converters``: column pattern -> expression over the raw column, instead
    of the built-in conversion. ``post_processors``: whole-event frame
    transformations, in order. ``topic``: the topic expression.
    ``source``: gets the built-in source struct, returns the one to use.
    """

    converters: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    post_processors: list[Callable[[DataFrame], DataFrame]] = field(default_factory=list)
    topic: Callable[[CdcConfig], Column] | None = None
    source: Callable[[Column], Column] | None = None

    def converter_for(self, name: str, config: CdcConfig) -> Callable[[Column], Column] | None:
        """The first converter whose pattern matches the column."""
        for pattern, convert in self.converters.items():
            if matching([name], [pattern], f"{config.db}.{config.table}"):
                return convert
        return None

    def process(self, events: DataFrame) -> DataFrame:
        for step in self.post_processors:
            events = events.transform(step)
        return events
