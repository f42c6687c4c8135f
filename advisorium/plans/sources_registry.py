"""Extension surface: publishers register listing and detail functions, rules and optional hooks."""

from __future__ import annotations

import importlib
import logging
import pkgutil
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nested import path_first
from ..operators.documents import PROVIDER_RULES, ROLES

Step = Callable[[DataFrame], DataFrame]
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ProviderRules:
    """Detail fields by role, in order of priority; compiled to expressions over a JSON detail column."""

    identity: tuple[str, ...] = ()
    title: tuple[str, ...] = ()
    cve: tuple[str, ...] = ()
    severity: tuple[str, ...] = ()
    published: tuple[str, ...] = ()
    updated: tuple[str, ...] = ()
    source: tuple[str, ...] = ()
    volatile: tuple[str, ...] = ()

    @classmethod
    def of(cls, rules: object) -> ProviderRules | None:
        """From an instance or a plain mapping; anything malformed is ignored with a warning."""
        if isinstance(rules, cls):
            return rules
        if isinstance(rules, dict) and set(rules) <= set(ROLES) and all(isinstance(v, (list, tuple)) and all(isinstance(x, str) for x in v) for v in rules.values()):
            return cls(**{k: tuple(v) for k, v in rules.items()})
        log.warning("ignoring malformed provider rules: %r", rules)
        return None

    def value(self, detail: Column, role: str) -> Column:
        """The first filled field of a role."""
        return path_first(detail, list(getattr(self, role)))


@dataclass(frozen=True)
class Source:
    key: str
    entries: Step
    detail: Step | None = None
    rules: ProviderRules = field(default_factory=ProviderRules)
    finalize: Step | None = None
    expand: Step | None = None


class SourceRegistry:
    """Sources by key.  ``discover`` loads every module of a package whose ``source`` has the module's name as key; broken ones are skipped with a warning."""

    def __init__(self) -> None:
        self._sources: dict[str, Source] = {}

    def register(self, key: str, entries: Step, detail: Step | None = None, rules: object = None, finalize: Step | None = None, expand: Step | None = None) -> Source:
        if key in self._sources:
            raise ValueError(f"source {key} is registered twice")
        known = {k: tuple(v) for k, v in PROVIDER_RULES.get(key, {}).items()}
        found = ProviderRules.of(rules) if rules is not None else None
        self._sources[key] = source = Source(key, entries, detail, found or ProviderRules(**known), finalize, expand)
        return source

    def keys(self) -> list[str]:
        return sorted(self._sources)

    def __getitem__(self, key: str) -> Source:
        return self._sources[key]

    def discover(self, package: str) -> list[str]:
        root = importlib.import_module(package)
        for info in pkgutil.iter_modules(root.__path__):
            try:
                source = importlib.import_module(f"{package}.{info.name}").source
                if source.key != info.name:
                    raise ValueError(f"its key is {source.key}")
                self._sources[source.key] = source
            except Exception as error:  # a broken plug-in must not stop the others
                log.warning("skipping source %s: %s", info.name, error)
        return self.keys()

    def run(self, key: str, landed: DataFrame) -> DataFrame:
        """Entries of landed payloads through the source's optional steps, with its key as provider."""
        source = self[key]
        rows = source.entries(landed.where(F.col("provider") == key) if "provider" in landed.columns else landed)
        for step in (source.detail, source.expand, source.finalize):
            rows = step(rows) if step else rows
        return rows.withColumn("provider", F.lit(key))
