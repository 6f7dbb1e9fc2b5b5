"""Stateful processors by themselves: a handle held in memory shows what they keep, which timers they set, and that their
state is empty when it should be."""

import json
import random

import pandas as pd

from eventide.streaming import generic, stateful


class Value:
    def __init__(self):
        self.v = None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v

    def clear(self):
        self.v = None


class Listed(list):
    def get(self):
        return iter(list(self))

    def put(self, rows):
        self[:] = rows

    def appendList(self, rows):
        self.extend(rows)


class Mapped(dict):
    reads = 0

    def getValue(self, k):
        self.reads += 1
        return self.get(k)

    def updateValue(self, k, v):
        self[k] = v

    def removeKey(self, k):
        self.pop(k, None)

    def iterator(self):
        return iter(list(self.items()))


class Handle:
    """State of one key, and its timers."""

    def __init__(self):
        self.states, self.timers = {}, set()

    def getValueState(self, name, schema):
        return self.states.setdefault(name, Value())

    def getListState(self, name, schema):
        return self.states.setdefault(name, Listed())

    def getMapState(self, name, keys, values):
        return self.states.setdefault(name, Mapped())

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.discard(ms)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    def getExpiryTimeInMs(self):
        return self.ms


class Key:
    """One key's processor, fed batch by batch; after each, the timers that the watermark has passed fire in order."""

    def __init__(self, processor, key):
        self.p, self.key, self.handle, self.out = processor, key, Handle(), []
        processor.init(self.handle)

    def batch(self, rows, watermark_ms):
        if len(rows):
            self.out += [tuple(r) for df in self.p.handleInputRows(self.key, iter([rows]), At(watermark_ms)) for r in df.itertuples(index=False)]
        while due := sorted(t for t in self.handle.timers if t <= watermark_ms):
            self.handle.timers.discard(due[0])
            self.out += [tuple(r) for df in self.p.handleExpiredTimer(self.key, At(watermark_ms), At(due[0])) for r in df.itertuples(index=False)]


def test_ranking_is_reported_corrected_and_cleared():
    end = 3_600_000
    k = Key(stateful.PageRankingProcessor(2, 60_000), (end * 1000, 0))
    views = lambda *urls: pd.DataFrame({"url": list(urls)})
    k.batch(views("/a", "/b", "/a", "/c"), end - 120_000)
    assert k.out == [] and len(k.handle.states["counts"]) == 3
    k.batch(views("/b"), end - 60_000)  # the window's end is passed: the report
    assert [r[3:] for r in k.out] == [("/a", 2, 1), ("/b", 2, 2)]
    k.batch(views("/c", "/c", "/c"), end - 30_000)  # late, but within the lateness: a correction
    assert [r[3:] for r in k.out[2:]] == [("/c", 4, 1), ("/a", 2, 2)] and k.out[2][2] > k.out[0][2]
    k.batch(views(), end - 1)
    assert len(k.out) == 4 and k.handle.states["counts"]
    k.batch(views(), end)
    assert len(k.out) == 4 and not k.handle.states["counts"] and not k.handle.timers


def test_bloom_bits_fire_once_and_go():
    k = Key(stateful.BloomChangelogProcessor(1_000_000), (0,))
    offsets = [5, 63, 64, 5, 2 ** 29 - 1, 63, 127]
    seen, want = set(), []
    for seq, o in enumerate(offsets):
        if o not in seen:
            seen.add(o)
            want.append((0, o, seq, len(seen)))
    rows = pd.DataFrame({"seq": range(7), "offset": offsets})
    for lo, hi in ((0, 1), (1, 3), (3, 7)):
        k.batch(rows[lo:hi].sample(frac=1, random_state=1), 10)
    assert k.out == want and len(k.handle.states["words"]) == 3
    k.batch(rows[:0], 1000)
    assert k.out == want and not k.handle.states["words"] and k.handle.states["count"].get() is None and not k.handle.timers


class Seen:
    def init(self, handle):
        pass

    def handleInputRows(self, key, rows, timerValues):
        for df in rows:
            yield df.sort_values("ts_us")[["ts_us", "v"]]

    def close(self):
        pass


def test_held_rows_come_in_order_and_only_due_buckets_are_read():
    rng = random.Random(2)
    rows = [(t * 1000, rng.choice([1.5, 2.0])) for t in range(0, 2000, 7)]
    k = Key(generic.InOrder(Seen(), ["ts_us", "v"], "ts_us", 100_000), ("x",))
    arrival = sorted(rows, key=lambda r: r[0] + rng.randrange(0, 300_000))
    held = k.handle.states["held"]
    for at in range(0, len(arrival), 20):
        part = arrival[at:at + 20]
        watermark = max(r[0] for r in arrival[:at + 20]) // 1000 - 301
        k.batch(pd.DataFrame(part, columns=["ts_us", "v"]), watermark)
        assert all((b[0] + 1) * 100 > watermark for b in held)  # what is due is gone, the rest is untouched
    before = held.reads
    k.batch(pd.DataFrame([], columns=["ts_us", "v"]), 10 ** 6)
    assert held.reads - before <= 6 and not held and [r[0] for r in k.out] == [r[0] for r in rows] and sorted(k.out) == sorted(rows)
    k.batch(pd.DataFrame([(5_000_000_000, 1.0)], columns=["ts_us", "v"]), 10 ** 6)
    assert json.loads(held[(50_000,)][0]) == [[5_000_000_000, 1.0]]


def test_failure_runs_against_a_plain_loop():
    rng = random.Random(5)
    rows = sorted((rng.randrange(0, 60) * 1000, i, rng.random() < 0.8) for i in range(70))
    want = []
    for i, (t, _, fail) in enumerate(rows):
        due = t + 5000
        if fail and not any(not f and x <= due for x, _, f in rows[i + 1:]):
            start = max((j + 1 for j in range(i) if not rows[j][2]), default=0)
            n = sum(f and x <= due for x, _, f in rows[start:])
            if n >= 2:
                want.append((1, rows[start][0], t, n))
    for size in (1, 9, 70):
        k = Key(stateful.RepeatedFailureProcessor(2, 5000), (1,))
        for at in range(0, 70, size):
            part = rows[at:at + size]
            k.batch(pd.DataFrame(part, columns=["ts_us", "seq", "fail"]), (part[-1][0] - 1) // 1000)
        k.batch(pd.DataFrame([], columns=["ts_us", "seq", "fail"]), 10 ** 6)
        assert sorted(k.out) == sorted(want) and want
        assert not k.handle.states["waiting"]


def test_reconcile_in_disorder_against_a_plain_slot():
    rng = random.Random(6)
    rows = sorted((rng.randrange(0, 4000) * 1000, rng.randrange(2), i) for i in range(80))
    want, wait = [], None
    single = lambda w: (("x", None, None, w[2], w[0], "r") if w[1] else ("x", w[2], w[0], None, None, "o"))
    for row in rows:
        if wait and wait[1] != row[1] and row[0] - wait[0] <= 60_000:
            a, b = (wait, row) if row[1] else (row, wait)
            want.append(("x", a[2], a[0], b[2], b[0], "m"))
            wait = None
        else:
            if wait:
                want.append(single(wait))
            wait = row
    if wait:
        want.append(single(wait))
    for width in (50_000, 1_000_000):
        k = Key(stateful.ReconcileProcessor(60_000, ("m", "o", "r"), width), ("x",))
        arrival = sorted(rows, key=lambda r: r[0] + rng.randrange(0, 200_000))
        for at in range(0, 80, 10):
            k.batch(pd.DataFrame(arrival[at:at + 10], columns=["ts_us", "side", "seq"]), max(r[0] for r in arrival[:at + 10]) // 1000 - 201)
        k.batch(pd.DataFrame([], columns=["ts_us", "side", "seq"]), 10 ** 7)
        got = [tuple(None if x is None or x != x else x for x in r) for r in k.out]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert not k.handle.states["held"] and k.handle.states["slot"].get() is None
