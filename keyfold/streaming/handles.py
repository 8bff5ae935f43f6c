"""State handles of one event, staged over a key's stored state.

A store offers ``get``, ``put``, ``remove`` and ``items`` on named tables; Spark's
state variables and plain dictionaries both fit. Writes are staged: they reach the
store on ``commit`` and vanish on ``rollback``. Items expire on read, by the
time of their own write.
"""

from __future__ import annotations

import json
import math

from keyfold.functions.exceptions import PermanentStateError, TransientStateError
from keyfold.state.definitions import Collection
from keyfold.streaming.message import Message

MISSING = object()


def clean(value):
    """A value as JSON can hold it: NaN and the infinities become null."""
    if isinstance(value, float) and not math.isfinite(value):
        return None
    if isinstance(value, dict):
        return {k: clean(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [clean(v) for v in value]
    return value


def to_json(value) -> str:
    try:
        return json.dumps(clean(value), ensure_ascii=False)
    except (TypeError, ValueError) as error:
        raise TransientStateError(f"value has no JSON form: {error}") from error


class Handle:
    """Items are checked and written here; subclasses add their shape."""

    def __init__(self, definition: Collection, store, now_us: int):
        self.definition, self.store, self.now_us = definition, store, now_us
        self.rollback()

    def _encode(self, item):
        is_message = isinstance(item, Message)
        if self.definition.payload == "message":
            if not is_message:
                raise TransientStateError("a message collection takes messages only")
            return item.to_json()
        if is_message:
            raise TransientStateError("a JSON collection cannot take a message")
        text = to_json(item)
        if text == "null":
            raise TransientStateError("null cannot be stored; use clear or delete")
        return text

    def _decode(self, cell):
        """A stored ``(text, write_us)`` as an item, None when absent or expired."""
        if cell is None:
            return None
        text, write_us = cell
        if expired(self.definition, write_us, self.now_us):
            return None
        return Message.from_json(text) if self.definition.payload == "message" else json.loads(text)

    def _live(self, cell) -> bool:
        return cell is not None and not expired(self.definition, cell[1], self.now_us)


class ValueHandle(Handle):
    def rollback(self):
        self._staged = MISSING

    def _cell(self):
        if self._staged is not MISSING:
            return self._staged
        return self.store.get(self.definition.name, "")

    def get(self):
        return self._decode(self._cell())

    def set(self, item):
        self._staged = (self._encode(item), self.now_us)

    def clear(self):
        self._staged = None

    def commit(self):
        if self._staged is None:
            self.store.remove(self.definition.name, "")
        elif self._staged is not MISSING:
            self.store.put(self.definition.name, "", self._staged)
        self.rollback()


class MapHandle(Handle):
    def rollback(self):
        self._cleared, self._staged = False, {}

    def _cell(self, key):
        if key in self._staged:
            return self._staged[key]
        return None if self._cleared else self.store.get(self.definition.name, key)

    def _cells(self):
        cells = {} if self._cleared else dict(self.store.items(self.definition.name))
        cells.update(self._staged)
        return {k: c for k, c in cells.items() if self._live(c)}

    def get(self, key):
        return self._decode(self._cell(key))

    def get_many(self, keys):
        return [self.get(k) for k in keys]

    def has(self, key):
        return self._live(self._cell(key))

    def set(self, key, item):
        self._staged[key] = (self._encode(item), self.now_us)

    def delete(self, key):
        self._staged[key] = None

    def clear(self):
        self._cleared, self._staged = True, {}

    def keys(self, backward=False):
        return iter(sorted(self._cells(), reverse=backward))

    def entries(self, backward=False):
        cells = self._cells()
        return ((k, self._decode(cells[k])) for k in sorted(cells, reverse=backward))

    def values(self, backward=False):
        return (item for _, item in self.entries(backward))

    __iter__ = entries

    def commit(self):
        name = self.definition.name
        if self._cleared:
            for key in [k for k, _ in self.store.items(name)]:
                self.store.remove(name, key)
        for key, cell in self._staged.items():
            if cell is None:
                self.store.remove(name, key)
            else:
                self.store.put(name, key, cell)
        self.rollback()


class DequeHandle(Handle):
    """Items lie at rising positions; only the ends and touched items are moved."""

    def rollback(self):
        self._ends = None
        self._staged = {}

    @property
    def _ends_name(self):
        return self.definition.name + "_ends"

    def _stored_ends(self):
        """Front and back; all items are gone once the last write is that old."""
        front, back, write_us = self.store.get(self._ends_name, "") or (0, 0, self.now_us)
        return (front, back) if self._live((None, write_us)) else (back, back)

    def _range(self):
        if self._ends is None:
            self._ends = self._stored_ends()
        return self._ends

    def _cell(self, position):
        if position in self._staged:
            return self._staged[position]
        return self.store.get(self.definition.name, position)

    def _put(self, position, item, front, back):
        self._staged[position] = (self._encode(item), self.now_us)
        self._ends = (front, back)

    def push(self, item):
        front, back = self._range()
        limit = self.definition.capacity
        back += 1
        self._put(back - 1, item, front if limit is None else max(front, back - limit), back)

    def unshift(self, item):
        front, back = self._range()
        limit = self.definition.capacity
        front -= 1
        self._put(front, item, front, back if limit is None else min(back, front + limit))

    def pop(self):
        front, back = self._range()
        if front == back:
            return None
        self._ends = (front, back - 1)
        return self._decode(self._cell(back - 1))

    def shift(self):
        front, back = self._range()
        if front == back:
            return None
        self._ends = (front + 1, back)
        return self._decode(self._cell(front))

    def clear(self):
        self._ends = (self._range()[1],) * 2

    def length(self):
        front, back = self._range()
        return back - front

    def is_empty(self):
        return self.length() == 0

    def at(self, index):
        if isinstance(index, bool) or not isinstance(index, (int, float)) or index != index or (
            isinstance(index, float) and not index.is_integer()
        ):
            raise TransientStateError(f"index must be a whole number, got {index!r}")
        front, back = self._range()
        position = (front if index >= 0 else back) + int(index)
        return self._decode(self._cell(position)) if front <= position < back else None

    def values(self, backward=False):
        positions = range(*self._range())
        for position in reversed(positions) if backward else positions:
            item = self._decode(self._cell(position))
            if item is not None:
                yield item

    __iter__ = values

    def commit(self):
        if self._ends is not None:
            name, (front, back) = self.definition.name, self._ends
            old_front, old_back = self._stored_ends()
            # only what left at either end
            for gone in (range(old_front, min(front, old_back)), range(max(back, old_front, front), old_back)):
                for position in gone:
                    self.store.remove(name, position)
            for position, cell in self._staged.items():
                if front <= position < back:
                    self.store.put(name, position, cell, new=not old_front <= position < old_back)
            if (front, back) != (old_front, old_back):
                self.store.put(self._ends_name, "", (front, back, self.now_us))
        self.rollback()


def expired(definition: Collection, write_us: int, now_us: int) -> bool:
    ttl = definition.ttl_seconds
    return ttl is not None and write_us + ttl * 1_000_000 <= now_us


HANDLES = {"value": ValueHandle, "map": MapHandle, "deque": DequeHandle}


def open_handle(registered: dict[str, Collection], definition: Collection, store, now_us: int) -> Handle:
    if registered.get(definition.name) != definition:
        raise PermanentStateError(f"collection {definition.name!r} is not registered like this")
    return HANDLES[definition.kind](definition, store, now_us)
