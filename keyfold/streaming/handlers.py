"""Ready-made handlers: activity windows, timers, counters."""

from __future__ import annotations

from keyfold.state import definitions
from keyfold.streaming.handler import SECOND


class WindowNotify:
    """First message at once, later ones of the window in one summary.

    Emits ``{kind, window_start_us, fire_us, ids}``; ``ids`` are record offsets.
    """

    def __init__(self, width_seconds: int = 300, capacity: int = 100, ttl_seconds: int | None = None):
        self.width_us = width_seconds * SECOND
        self.window = definitions.value("window", ttl_seconds=ttl_seconds)
        self.pending = definitions.message_deque("pending", capacity=capacity, ttl_seconds=ttl_seconds)
        self.collections = [self.window, self.pending]

    def on_message(self, ctx, message):
        window = ctx.state(self.window)
        if window.get() is None:
            ctx.emit({"kind": "first", "window_start_us": ctx.now_us, "ids": [message.off]})
            window.set(ctx.now_us)
            ctx.clear_and_schedule(ctx.now_us + self.width_us)
        else:
            ctx.state(self.pending).push(message)

    def on_excise(self, ctx, message):
        ctx.state(self.pending).clear()
        ctx.state(self.window).clear()
        ctx.clear_scheduled()

    def on_timer(self, ctx, timer):
        window, pending = ctx.state(self.window), ctx.state(self.pending)
        ids = [m.off for m in pending.values()]
        if ids:
            ctx.emit({"kind": "summary", "window_start_us": window.get(), "ids": ids})
        pending.clear()
        window.clear()


class TimerLog:
    """Applies timer operations in the payload and emits the timers that fire.

    A payload is ``{op, fire_us}`` with the operations of ``operators.timers``.
    """

    collections = ()

    def on_message(self, ctx, message):
        op, fire_us = message.payload["op"], message.payload.get("fire_us")
        if op == "schedule":
            ctx.schedule(fire_us)
        elif op == "clear_and_schedule":
            ctx.clear_and_schedule(fire_us)
        elif op == "unschedule":
            if fire_us is not None:
                ctx.unschedule(fire_us)
        elif op == "clear":
            ctx.clear_scheduled()

    def on_excise(self, ctx, message):
        ctx.clear_scheduled()

    def on_timer(self, ctx, timer):
        ctx.emit({"fire_us": timer.time_us})


class KeyCounter:
    """Counts a key's records; starts over once the key was idle for the TTL."""

    def __init__(self, ttl_seconds: int):
        self.count = definitions.value("count", ttl_seconds=ttl_seconds)
        self.collections = [self.count]

    def on_message(self, ctx, message):
        count = ctx.state(self.count)
        count.set((count.get() or 0) + 1)
        return {"count": count.get()}

    def on_excise(self, ctx, message):
        ctx.state(self.count).clear()

    def on_timer(self, ctx, timer):
        pass
