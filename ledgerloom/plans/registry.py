"""Adapters by name: what an import asks of a vendor, and the one place where a new one is plugged in."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import basename
from ledgerloom.operators.members import DECISIONS, RuleViolation

Tables = tuple[DataFrame, DataFrame]


def _nothing(frame: DataFrame) -> DataFrame:
    """No offender."""
    return frame.sparkSession.createDataFrame([], "code string, subject string")


@dataclass(frozen=True)
class Adapter:
    """A vendor's format.

    ``discover`` keeps the members (path, ...) that hold messages; ``parse`` turns payloads (source_path, raw) into canonical
    conversations and messages.  ``discovery_violations`` and ``payload_violations`` (code, subject) refuse what can't be read.
    ``override`` is the adapter's own struct of decision and reason for a path, null where the policy decides; ``reference_key``
    the key under which messages refer to a member.  ``contexts`` gives the conversations whose strings may refer to members by any
    key; without it messages do, by that one key.  ``placed``: messages have a source path.
    """

    name: str
    adapter_id: str
    vendor: str
    source_type: str
    discover: Callable[[DataFrame], DataFrame]
    parse: Callable[[DataFrame], Tables]
    discovery_violations: Callable[[DataFrame], DataFrame] = _nothing
    payload_violations: Callable[[DataFrame], DataFrame] = _nothing
    override: Callable[[Column], Column | None] = lambda path: None
    reference_key: Callable[[Column], Column] = basename
    contexts: Callable[[DataFrame], DataFrame] | None = None
    placed: bool = True

    @property
    def identity(self) -> tuple[str, str, str]:
        return self.adapter_id, self.vendor, self.source_type


_ADAPTERS: dict[str, Adapter] = {}


def register(adapter: Adapter, replace: bool = False) -> Adapter:
    """Make ``adapter`` known by its name; a name that is taken is refused unless ``replace``."""
    if adapter.name in _ADAPTERS and not replace:
        raise ValueError(f"adapter_exists: {adapter.name}")
    _ADAPTERS[adapter.name] = adapter
    return adapter


def adapter(name: str) -> Adapter:
    """The adapter of that name."""
    if name not in _ADAPTERS:
        raise ValueError(f"unknown_adapter: {name}")
    return _ADAPTERS[name]


def adapter_names() -> tuple[str, ...]:
    return tuple(sorted(_ADAPTERS))


def descriptors(spark) -> DataFrame:
    """name, adapter_id, source_vendor, source_type of every adapter, by name."""
    return spark.createDataFrame([(n, *_ADAPTERS[n].identity) for n in adapter_names()], "name string, adapter_id string, source_vendor string, source_type string")


def checked_override(members: DataFrame, own: Adapter) -> Column | None:
    """The adapter's override for ``members`` (path), once no decision of it is outside the four."""
    found = own.override(F.col("path"))
    if found is not None:
        for row in members.where(found.isNotNull() & ~F.coalesce(found["decision"].isin(*DECISIONS), F.lit(False))).select("path").orderBy("path").limit(1).collect():
            raise RuleViolation("invalid_member_decision", row["path"])
    return found
