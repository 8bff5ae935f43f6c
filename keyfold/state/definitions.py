"""Typed, checked definitions of keyed state collections."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import types as T

KINDS = ("value", "map", "deque")
PAYLOADS = ("json", "message")
U32_MAX = 2**32 - 1
KEYSET_MAX = 4096


class DefinitionError(ValueError):
    """A malformed definition: permanent, no retry can mend it."""


@dataclass(frozen=True)
class Collection:
    """What a collection is; two definitions may not share a name.

    ``read_cache_ms`` is the time to live of published reads: None inherits the
    default and 0 turns the cache off. ``keyset_limit`` is accepted for maps and
    has no effect here.
    """

    name: str
    kind: str
    payload: str = "json"
    ttl_seconds: int | None = None
    read_uncommitted: bool = False
    published: bool = False
    read_cache_ms: int | None = None
    keyset_limit: int | None = None
    capacity: int | None = None

    def __post_init__(self):
        if not isinstance(self.name, str) or not self.name:
            raise DefinitionError("name: must be a non-empty string")
        if self.kind not in KINDS:
            raise DefinitionError(f"kind: expected one of {KINDS}, got {self.kind!r}")
        if self.payload not in PAYLOADS:
            raise DefinitionError(f"payload: expected one of {PAYLOADS}, got {self.payload!r}")
        if self.keyset_limit is not None and self.kind != "map":
            raise DefinitionError("keyset_limit: only valid for map collections")
        if self.capacity is not None and self.kind != "deque":
            raise DefinitionError("capacity: only valid for deque collections")
        if self.published and self.payload != "json":
            raise DefinitionError("published: only JSON collections can be published")
        self._whole("ttl_seconds", 1, U32_MAX)
        self._whole("keyset_limit", 0, KEYSET_MAX)
        self._whole("capacity", 1, U32_MAX)
        self._whole("read_cache_ms", 0, U32_MAX)

    def _whole(self, field: str, low: int, high: int) -> None:
        value = getattr(self, field)
        if value is None:
            return
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        if not number or not math.isfinite(value) or value != int(value) or not low <= value <= high:
            raise DefinitionError(f"{field}: must be a whole number in {low}..={high}")
        object.__setattr__(self, field, int(value))

    @property
    def item_schema(self) -> T.StructType:
        """State columns of one item; the write time stands for the TTL."""
        return T.StructType([
            T.StructField("item", T.StringType()), T.StructField("write_us", T.LongType()),
        ])


def value(name: str, **options) -> Collection:
    return Collection(name, "value", "json", **options)


def map(name: str, **options) -> Collection:  # noqa: A001 - the collection's own name
    return Collection(name, "map", "json", **options)


def deque(name: str, **options) -> Collection:
    return Collection(name, "deque", "json", **options)


def message_value(name: str, **options) -> Collection:
    return Collection(name, "value", "message", **options)


def message_map(name: str, **options) -> Collection:
    return Collection(name, "map", "message", **options)


def message_deque(name: str, **options) -> Collection:
    return Collection(name, "deque", "message", **options)


def register(collections: Iterable[Collection]) -> dict[str, Collection]:
    """Collections by name; a name used twice is an error."""
    found: dict[str, Collection] = {}
    for collection in collections:
        if not isinstance(collection, Collection):
            raise DefinitionError(f"not a collection definition: {collection!r}")
        if collection.name in found:
            raise DefinitionError(f"collection {collection.name!r} is defined twice")
        found[collection.name] = collection
    return found
