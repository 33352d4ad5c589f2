"""One sweep over a device's time buckets instead of one copy of every bucket per window.

Time is counted in buckets (gcd of window size and slide). A window that ends at
bucket ``e`` covers the buckets from ``e - width`` up to, not including, ``e``.
While the sweep stands behind bucket ``j`` (the next one is ``j2``) two numbers decide
every window that ends after ``j`` and not after ``j2``:

* ``click``: the latest bucket with a click - a window must begin behind it;
* ``third``: of the latest ``accounts`` distinct accounts the earliest's last
  bucket - a window must begin there or before.

So each bucket gives one *range* of window ends, and only windows inside such
ranges are ever written out. Both numbers need the last ``accounts`` accounts and one bucket
number; the sets and events of alerted windows come from the buckets of one
window width, which are all that is held.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

COUPON, CLICK = 1, 2


@dataclass(slots=True)
class Bucket:
    """What a device did in one bucket; ``events`` is a time-ordered list."""
    at: int
    clicked: bool = False
    uids: set = field(default_factory=set)
    items: set = field(default_factory=set)
    events: list = field(default_factory=list)


@dataclass(frozen=True, slots=True)
class Rule:
    """Window ``width`` and ``slide`` in buckets, accounts needed; ``document`` (buckets) keeps
    only the newest alerted window of each run of so many window ends."""
    width: int
    slide: int
    accounts: int
    document: int | None = None


class Sweep:
    """Feeds on one device's buckets in time order; yields ``(end, uids, items, events)`` per alerted
    window with ``low <= end < high``, in order of time, the sets sorted."""

    def __init__(self, rule: Rule, low: int, high: int):
        self.rule, self.low, self.high = rule, low, high
        self.held: list[Bucket] = []
        self.last: dict = {}  # latest distinct accounts, oldest first, with their last bucket
        self.click = low - 2 * rule.width  # before every window
        self.waiting: int | None = None  # newest alerted end of its document so far
        self.now: Bucket | None = None

    def push(self, bucket: Bucket) -> Iterator[tuple]:
        if self.now is not None:
            yield from self._pass(bucket.at)
        self.now = bucket

    def end(self) -> Iterator[tuple]:
        if self.now is not None:
            yield from self._pass(None)
        self.now = None
        if self.waiting is not None:
            yield self._window(self.waiting)
            self.waiting = None

    def _pass(self, following: int | None) -> Iterator[tuple]:
        """The windows whose last bucket with events is the current one."""
        rule, now = self.rule, self.now
        self.held.append(now)
        if now.clicked:
            self.click = now.at
        for uid in now.uids:
            self.last.pop(uid, None)
            self.last[uid] = now.at
        while len(self.last) > rule.accounts:
            del self.last[next(iter(self.last))]
        if len(self.last) == rule.accounts:
            third = next(iter(self.last.values()))
            first = max(now.at + 1, self.click + 1 + rule.width, self.low)
            final = min(third + rule.width, self.high - 1, following if following is not None else third + rule.width)
            first += -(first - rule.width) % rule.slide
            if first <= final:
                yield from self._out(range(first, final + 1, rule.slide))
        if following is not None:
            keep = following + 1 - rule.width
            if self.waiting is not None:
                keep = min(keep, self.waiting - rule.width)
            gone = 0
            while gone < len(self.held) and self.held[gone].at < keep:
                gone += 1
            if gone:
                del self.held[:gone]

    def _out(self, ends: range) -> Iterator[tuple]:
        size = self.rule.document
        if size is None:
            yield from self._all(ends)
            return
        newest: dict[int, int] = {}
        for e in ends:
            newest[e // size] = e
        for e in newest.values():
            if self.waiting is not None and self.waiting // size != e // size:
                yield self._window(self.waiting)
            self.waiting = e

    def _all(self, ends: range) -> Iterator[tuple]:
        """Windows with one last bucket: from the latest end back, each adds the buckets it begins earlier by."""
        out, uids, items, n = [], set(), set(), len(self.held)
        sets = ([], [])
        for e in reversed(ends):
            grown = False
            while n and self.held[n - 1].at >= e - self.rule.width:
                n -= 1
                uids |= self.held[n].uids
                items |= self.held[n].items
                grown = True
            if grown:
                sets = (sorted(uids), sorted(items))
            out.append((e, *sets, [x for b in self.held[n:] for x in b.events]))
        yield from reversed(out)

    def _window(self, e: int) -> tuple:
        inside = [b for b in self.held if e - self.rule.width <= b.at < e]
        return (e, sorted(set().union(*(b.uids for b in inside))), sorted(set().union(*(b.items for b in inside))), [x for b in inside for x in b.events])


def alerted(buckets: Iterable[Bucket], rule: Rule, low: int, high: int) -> Iterator[tuple]:
    """The alerted windows of one device's buckets (in time order) with ``low <= end < high``."""
    sweep = Sweep(rule, low, high)
    for b in buckets:
        yield from sweep.push(b)
    yield from sweep.end()
