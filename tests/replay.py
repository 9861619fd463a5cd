"""Change sequences and their row-by-row replay, for comparison with the fold."""

from __future__ import annotations

import datetime as dt
import random

CHANGES = "operation_type string, changed_at timestamp, audit_id long, k string, a double, b string"
TARGET = "k string, a double, b string"
START = dt.datetime(2024, 1, 1)


def random_case(seed, keys=60, most=8, loaded=2, hot=0):
    """Changes in shuffled order with tied times and null values, and a preloaded target."""
    rng = random.Random(seed)

    def image():
        return (None if rng.random() < 0.2 else float(rng.randint(0, 99)), rng.choice(["x", "y", None]))

    target, changes, n = [], [], 0
    for k in range(keys):
        target += [(f"k{k}", *image()) for _ in range(rng.randint(0, loaded))]
        for _ in range(hot if k == 0 and hot else rng.randint(0, most)):
            n += 1
            at = START + dt.timedelta(seconds=rng.randint(0, 5))
            changes.append((rng.choice(["INSERT", "UPDATE", "DELETE"]), at, n, f"k{k}", *image()))
    rng.shuffle(changes)
    return target, changes


def in_order(changes):
    return sorted(changes, key=lambda c: (c[1], c[2]))


def replay(target, changes, bag):
    state = {}
    for k, *image in target:
        state.setdefault(k, []).append(tuple(image))
    for op, _, _, k, *image in in_order(changes):
        held = state.setdefault(k, [])
        if op == "INSERT" and (bag or not held):
            held.append(tuple(image))
        elif op == "UPDATE":
            state[k] = [tuple(image)] * len(held)
        elif op == "DELETE":
            state[k] = []
    return sorted(((k, *i) for k, held in state.items() for i in held), key=repr)
