"""Errors a handler raises, and how they are classified."""

from __future__ import annotations

import functools


class HandlerError(Exception):
    """Base of errors that say themselves whether a retry makes sense."""

    permanent = False


class TransientError(HandlerError):
    permanent = False


class PermanentError(HandlerError):
    permanent = True


class TransientStateError(TransientError):
    """A misuse of a state collection; it stays visible through retries."""


class PermanentStateError(PermanentError):
    """A collection that is not registered, or registered differently."""


def _wrapping(kind):
    def decorator(*types):
        def wrap(method):
            @functools.wraps(method)
            def call(*args, **kwargs):
                try:
                    return method(*args, **kwargs)
                except types as error:
                    raise kind(str(error)) from error

            return call

        return wrap

    return decorator


transient = _wrapping(TransientError)
permanent = _wrapping(PermanentError)


def is_permanent(error: BaseException) -> bool:
    """Everything that does not declare itself permanent is transient."""
    return getattr(error, "permanent", False) is True
