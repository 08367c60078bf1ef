"""Step functions of the single-timer state machines.

The timers are shared by the bounded form (``timers``) and the streaming form (a
stateful processor), which also uses the steps. Times are whole numbers of one
unit. A step takes the pending timer, or None, and one input; it returns the new
pending timer. Whether a timer has fired is decided before the step.

``due`` is the clock reading that fires a timer. A timer set at or behind the
current clock fires at the next advance of the clock.
"""

from __future__ import annotations

from typing import NamedTuple

LONG_AGO = -(2**62)  # clock before any watermark


class Timer(NamedTuple):
    time: int
    due: int


def set_timer(time: int, clock: int) -> Timer:
    return Timer(time, max(time, clock + 1))


def is_due(timer: Timer | None, clock: int) -> bool:
    return timer is not None and clock >= timer.due


def one_timer(timer: Timer | None, clock: int, base: int, delay: int) -> Timer:
    """At most one timer per key, at ``base + delay`` of the row that sets it."""
    return timer or set_timer(base + delay, clock)


def rising_event(timer: Timer | None, clock: int, base: int, reset: int | None, delay: int) -> Timer:
    """Rising-level alert on event time.

    The first row sets a timer; ``reset`` is the event time of the last row that
    did not rise, and moves it.
    """
    if reset is not None:
        return set_timer(reset + delay, clock)
    return timer or set_timer(base + delay, clock)


def rising_clock(timer: Timer | None, clock: int, fell: bool, rose_after_fall: bool, rose: bool,
                 delay: int) -> Timer | None:
    """Rising-level alert on the arrival clock: a fall clears, a rise sets."""
    if fell:
        timer = None
        rose = rose_after_fall
    if timer is None and rose:
        timer = set_timer(clock + delay, clock)
    return timer
