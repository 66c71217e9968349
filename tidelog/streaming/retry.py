"""Another attempt for passing failures."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from tidelog.functions.scalar import PERMANENT, RETRYABLE, backoff_seconds


@dataclass(frozen=True)
class RetryPolicy:
    max_attempts: int = 3
    base: float = 1.0
    most: float = 60.0
    multiplier: float = 2.0
    jitter: bool = True

    def wait(self, attempt: int) -> float:
        return backoff_seconds(attempt, self.base, self.multiplier, self.most, self.jitter)


def retryable(error: BaseException) -> bool:
    if isinstance(error, (ConnectionError, TimeoutError)):
        return True
    text = str(error).lower()
    return any(x in text for x in RETRYABLE) or not any(x in text for x in PERMANENT)


def call(action: Callable, policy: RetryPolicy, *args, sleep: Callable = time.sleep, **kwargs):
    for attempt in range(1, policy.max_attempts + 1):
        try:
            return action(*args, **kwargs)
        except Exception as e:
            if attempt == policy.max_attempts or not retryable(e):
                raise
            sleep(policy.wait(attempt))


def with_retry(policy: RetryPolicy):
    def decorate(f):
        @wraps(f)
        def inner(*args, **kwargs):
            return call(f, policy, *args, **kwargs)

        return inner

    return decorate
