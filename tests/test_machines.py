"""Timer machines against a record-by-record model of the same rules."""

import random

import pytest
from feeds import at, clock, sensor_frame

from brook.operators import keyed as K

BASE = 1549000000


class Model:
    """Processes rows one by one; clocks are whole seconds."""

    def __init__(self, rows, bound):
        self.rows, self.bound = rows, bound

    def events(self):
        """(key, ts, vc, arrival, wm before, wm after) in arrival order."""
        top = None
        for key, ts, vc, arrival in self.rows:
            before = None if top is None else top - self.bound
            top = ts if top is None else max(top, ts)
            yield key, ts, vc, arrival, before, top - self.bound

    def run_event(self, on_row):
        """``on_row(state, ts, vc) -> new timer or None``; timers fire when the watermark advances."""
        timers, fired, states = {}, [], {}
        now = float("-inf")
        for key, ts, vc, _, _, after in self.events():
            state = states.setdefault(key, {"last": None})
            timer = on_row(state, timers.get(key), ts, vc)
            state["last"] = vc
            if timer is not None:
                timers[key] = timer
            if after > now:
                now = after
                for k in [k for k, t in timers.items() if t <= now]:
                    fired.append((k, timers.pop(k)))
        return sorted(fired)

    def run_clock(self, on_row):
        """``on_row(state, timer, now, vc) -> timer or None`` to have none."""
        timers, fired, states = {}, [], {}
        for key, _, vc, now, _, _ in self.events():
            for k in [k for k, t in timers.items() if t <= now]:
                fired.append((k, timers.pop(k)))
            state = states.setdefault(key, {"last": 0})
            timer = on_row(state, timers.get(key), now, vc)
            state["last"] = vc
            if timer is None:
                timers.pop(key, None)
            else:
                timers[key] = timer
        return sorted(fired)


def feed(seed, n=160, keys=4, levels=6):
    rng = random.Random(seed)
    rows, now = [], 1000
    for _ in range(n):
        now += rng.choice([0, 0, 1, 1, 2, 9])
        # A lone far-ahead key makes the watermark pass other keys' rows.
        rows.append((f"s{rng.randrange(keys)}", now - rng.choice([0, 0, 1, 3, 6, 12]), rng.randrange(levels), now))
    return rows


def fired(df):
    return sorted((r.id, int((r.fire_time - at(0)).total_seconds())) for r in df.collect())


@pytest.mark.parametrize("seed", range(4))
def test_one_event_timer(spark, seed):
    rows = feed(seed)
    want = Model(rows, 2).run_event(lambda s, t, ts, vc: None if t is not None else ts + 5)
    assert fired(K.timer_one_per_key(sensor_frame(spark, rows))) == want


@pytest.mark.parametrize("seed", range(4))
def test_one_processing_timer(spark, seed):
    rows = feed(seed)
    want = Model(rows, 2).run_clock(lambda s, t, now, vc: t if t is not None else now + 5)
    assert fired(K.timer_one_per_key_processing(sensor_frame(spark, rows))) == want


@pytest.mark.parametrize("seed", range(6))
def test_rising_event(spark, seed):
    rows = feed(seed, levels=40)

    def on_row(s, timer, ts, vc):
        if timer is None or (s["last"] is not None and vc <= s["last"]):
            return ts + 5
        return None

    assert fired(K.rising_alert_event(sensor_frame(spark, rows))) == Model(rows, 2).run_event(on_row)


@pytest.mark.parametrize("seed", range(6))
def test_rising_processing(spark, seed):
    rows = feed(seed, levels=9)

    def on_row(s, timer, now, vc):
        if s["last"] == 0:
            return timer
        if vc < s["last"]:
            return None
        return now + 10 if vc > s["last"] and timer is None else timer

    assert fired(K.rising_alert_processing(sensor_frame(spark, rows))) == Model(rows, 2).run_clock(on_row)


@pytest.mark.parametrize("seed", range(4))
def test_timer_per_event(spark, seed):
    rows = feed(seed)
    pending, want, now = set(), set(), float("-inf")
    for key, ts, _, _, _, after in Model(rows, 2).events():
        pending.add((key, ts + 5))
        if after > now:
            now = after
            done = {(k, t, now) for k, t in pending if t <= now}
            want |= done
            pending -= {(k, t) for k, t, _ in done}
    got = {
        (r.id, int((r.fire_time - at(0)).total_seconds()), int((r.watermark - at(0)).total_seconds()))
        for r in K.timer_per_event(sensor_frame(spark, rows)).collect()}
    assert got == want


@pytest.mark.parametrize("seed", range(4))
def test_self_cleaning(spark, seed):
    rows = feed(seed, levels=60)
    timers, last, want, now = {}, {}, [], float("-inf")
    for i, (key, ts, vc, _, _, after) in enumerate(Model(rows, 2).events()):
        diff = abs(vc - last.get(key, 0))
        if diff > 10:
            want.append((i, diff))
        timers[key], last[key] = ts + 8, vc
        if after > now:
            now = after
            for k in [k for k, t in timers.items() if t <= now]:
                del timers[k]
                last.pop(k)
    got = K.jump_alert_self_cleaning(sensor_frame(spark, rows), 10, "8 seconds").collect()
    assert sorted((r.event_id, r.diff) for r in got) == want


def test_open_timers_are_told_apart(spark):
    rows = sensor_frame(spark, [("a", 1, 1, 1), ("a", 100, 2, 100)])
    got = {(clock(r.fire_time) + BASE, r.fired) for r in K.timer_one_per_key(rows, keep_open=True).collect()}
    assert got == {(6, True)}
    late = K.timer_one_per_key_processing(rows, keep_open=True).collect()
    assert {(clock(r.fire_time) + BASE, r.fired) for r in late} == {(6, True), (105, False)}
