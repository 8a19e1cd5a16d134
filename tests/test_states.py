"""State machines on chunks of a key's rows, in any order within a trigger."""

import itertools
from types import SimpleNamespace

import pandas as pd

from agentlake.streaming.state import Board, Seen


class Value:
    def __init__(self):
        self.v = None

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v


class Handle:
    def getValueState(self, *a):  # noqa: N802
        return Value()

    def listTimers(self):  # noqa: N802
        return []

    def registerTimer(self, at):  # noqa: N802
        self.at = at


TIMES = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: 0)


def run(machine, *chunks):
    return pd.concat(list(machine.handleInputRows(("s",), iter(chunks), TIMES)))


def test_seen_keeps_the_first_of_all_chunks():
    chunks = [pd.DataFrame({"event_id": [5, 3], "x": ["e", "c"]}), pd.DataFrame({"event_id": [9, 2], "x": ["i", "b"]})]
    for order in itertools.permutations(chunks):
        m = Seen(1, "event_id")
        m.init(Handle())
        assert run(m, *order).values.tolist() == [[2, "b"]]
        assert run(m, *order).empty


def test_board_folds_chunks():
    columns = ["event_id", "ts_s", "event", "wo"]
    rows = [(1, 10, "session-end", None), (2, 20, "session-start", None), (3, 30, "prompt", "first"), (4, 40, "prompt", None), (5, 50, "session-end", None)]
    for order in itertools.permutations(rows):
        m = Board(3_600, 43_200)
        h = Handle()
        m.init(h)
        got = run(m, *(pd.DataFrame(order[i : i + 2], columns=columns) for i in range(0, 5, 2)))
        assert got.values.tolist() == [["s", 20, 50, "ended", "first", False]] and h.at == 3_600_000
        got = run(m, pd.DataFrame([(6, 60, "prompt", "more")], columns=columns))
        assert got.values.tolist() == [["s", 20, 60, "active", "more", False]]
        got = run(m, pd.DataFrame([(7, 70, "post-tool", None)], columns=columns))
        assert got.values.tolist() == [["s", 20, 60, "active", "more", False]]
    m = Board(3_600, 43_200)
    m.init(Handle())
    assert run(m, pd.DataFrame(rows[:1], columns=columns)).empty
