"""A record as handlers and message collections see it."""

from __future__ import annotations

import json
from dataclasses import dataclass

from keyfold.functions.exceptions import PermanentError


@dataclass(frozen=True)
class Message:
    topic: str
    part: int
    off: int
    ts_us: int
    key: str
    text: str | None

    @property
    def payload(self):
        """The parsed payload; text that is not JSON is a permanent error."""
        try:
            return json.loads(self.text, parse_constant=_refuse)
        except ValueError as error:
            raise PermanentError(f"message payload is not JSON: {error}") from error

    def to_json(self) -> str:
        return json.dumps([self.topic, self.part, self.off, self.ts_us, self.key, self.text])

    @staticmethod
    def from_json(text: str) -> Message:
        return Message(*json.loads(text))


def _refuse(name):
    raise ValueError(f"{name} is not JSON")
