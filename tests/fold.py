"""Plain sessions of small inputs, event by event, to compare the operators with."""

from __future__ import annotations

import random

KINDS = {"view": "items_viewed", "addtocart": "items_carted", "transaction": "items_purchased"}
COUNTERS = {"view": "view_count", "addtocart": "cart_count", "transaction": "transaction_count"}


def fold(events, timeout, state=None):
    """All sessions touched by ``events`` (ts, visitor, kind, item, seq), by session id."""
    current, touched = dict(state or {}), {}
    for ts, visitor, kind, item, _ in sorted(events, key=lambda e: (e[0], e[4])):
        s = current.get(visitor)
        if s is None or s["last_activity"] == 0 or ts - s["last_activity"] > timeout:
            number = s["session_num"] + 1 if s else 1
            s = dict(session_id=f"{visitor}_{number}", visitor_id=visitor, session_num=number,
                     session_start=ts, session_end=ts, event_count=0, last_activity=ts,
                     **{c: 0 for c in COUNTERS.values()}, **{c: [] for c in KINDS.values()})
            current[visitor] = s
        s["event_count"] += 1
        s["session_end"] = max(s["session_end"], ts)
        s["last_activity"] = ts
        if kind in KINDS:
            s[COUNTERS[kind]] += 1
            if item not in s[KINDS[kind]]:
                s[KINDS[kind]].append(item)
        touched[s["session_id"]] = s
    return touched, current


def random_events(seed, n=300, visitors=5, timeout=1000, span=60_000):
    """Events with repeated keys, equal times, unknown kinds and gaps at the timeout."""
    rng = random.Random(seed)
    kinds = ["view", "addtocart", "transaction", "signup"]
    rows, clock = [], {}
    for seq in range(n):
        visitor = 1 if rng.random() < 0.4 else rng.randrange(1, visitors + 1)
        last = clock.get(visitor, 5000)
        step = rng.choice([0, 0, 1, 500, timeout - 1, timeout, timeout + 1, 3 * timeout])
        ts = last + step
        clock[visitor] = ts
        rows.append((ts, visitor, rng.choice(kinds), rng.randrange(1, 7), seq))
    return rows
