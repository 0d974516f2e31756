"""The state of the settle timers: a bucket of runs takes a few state calls, however many runs it has."""

import pandas as pd

from helixframe.streaming import runs as T


class Value:
    def __init__(self, calls):
        self.held, self.calls = None, calls

    def exists(self):
        self.calls.append("exists")
        return self.held is not None

    def get(self):
        self.calls.append("get")
        return self.held

    def update(self, value):
        self.calls.append("update")
        self.held = value

    def clear(self):
        self.calls.append("clear")
        self.held = None


class Handle:
    def __init__(self):
        self.calls, self.timers = [], set()

    def getValueState(self, *a):
        return Value(self.calls)

    def registerTimer(self, at):
        self.calls.append("timer")
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getExpiryTimeInMs(self):
        return self.ms

    def getCurrentWatermarkInMs(self):
        return self.ms + 1


def test_a_bucket_of_runs_takes_few_state_calls():
    handle, settle = Handle(), T.SettleByEventTime(3600, 100)
    settle.init(handle)
    n, never = 3000, T.NEVER
    one = lambda k, **at: {"instrument": "i", "flowcell": f"FC{k}", "version": "1.9" if k % 2 else "", **dict.fromkeys(T.FIRST, never), **at}
    rows = [one(k, finished=1000 + k) for k in range(n)] + [one(n + 1, copy0=5, copy1=7, copy2=9_000_000), one(n + 2, copy0=5, copy1=7, copy2=9), one(n + 3, copy0=5, copy1=7), {**one(n + 4, complete=3), "flowcell": "SN601_FC"}]
    assert list(settle.handleInputRows((0,), iter([pd.DataFrame(rows[:2000]), pd.DataFrame(rows[2000:])]), None)) == []
    assert handle.timers == {1000} and len(handle.calls) < 20
    handle.timers.clear()
    got = pd.concat(settle.handleExpiredTimer((0,), At(1000 + n), At(1000 + n)))
    assert dict(zip(got["flowcell"], got["ready"], strict=True)) == {f"FC{k}": 1000 + k for k in range(n)}
    assert len(handle.calls) < 40 and handle.timers == {101_000}
    handle.timers.clear()
    assert list(settle.handleExpiredTimer((0,), At(200_000), At(200_000))) == [] and handle.timers == {9_000_000}
    last = pd.concat(settle.handleExpiredTimer((0,), At(9_000_000), At(9_000_000)))
    assert last[["flowcell", "ready"]].values.tolist() == [[f"FC{n + 1}", 9_000_000]]
