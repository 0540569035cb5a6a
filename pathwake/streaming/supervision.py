"""Several streams at once: one that fails is started again, the others go on."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQuery

Start = Callable[[], StreamingQuery]


class GivenUp(RuntimeError):
    """Streams that failed more often than they may; ``errors`` by name."""

    def __init__(self, errors: dict[str, Exception]):
        super().__init__(f"streams given up: {', '.join(sorted(errors))}")
        self.errors = errors


def supervise(starts: dict[str, Start], attempts: int = 5, delay_sec: float = 1.0, poll_sec: float = 0.1) -> dict[str, int]:
    """Run streams until each has ended; returns how often each was started again.

    ``starts`` begin a stream, or go on from its checkpoint. After a failure a stream waits
    ``delay_sec``, twice as long after each further one in a row without progress, so a sink that
    is down is not pressed; its source keeps what it has not taken. A stream is given up after
    ``attempts`` failures without a finished batch in between; when the others have ended,
    :class:`GivenUp` names those.
    """
    running = {name: start() for name, start in starts.items()}
    restarts, failures = dict.fromkeys(starts, 0), dict.fromkeys(starts, 0)
    reached: dict[str, int] = {}
    waiting: dict[str, float] = {}
    errors: dict[str, Exception] = {}
    while running or waiting:
        for name, query in list(running.items()):
            if query.isActive:
                continue
            del running[name]
            error = query.exception()
            if error is None:
                continue
            last = query.lastProgress
            if last is not None and last["batchId"] > reached.get(name, -1):
                reached[name], failures[name] = last["batchId"], 0
            failures[name] += 1
            if failures[name] >= attempts:
                errors[name] = error
            else:
                waiting[name] = time.monotonic() + delay_sec * 2 ** (failures[name] - 1)
        for name, due in list(waiting.items()):
            if time.monotonic() >= due:
                del waiting[name]
                restarts[name] += 1
                running[name] = starts[name]()
        time.sleep(poll_sec)
    if errors:
        raise GivenUp(errors)
    return restarts
