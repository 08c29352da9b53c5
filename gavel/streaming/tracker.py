"""The state of live auctions as separate state variables, so that a trigger
rewrites what its messages touch and nothing else.

Per auction there is one small value: counts, countdown, flags and, as long as
there are few, all users with their numbers, so that a trigger reads and writes
an auction once. An auction of many users has a map from user to numbers, and
its value keeps the last few: a bid reads its user's entry unless that user is
among them, and each user touched is written once a trigger. The row before a
bid of mine is sent out as the stream reaches that bid.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gavel.schemas import LIVE_STATE, OPPONENTS

FIRST_SECONDS_LEFT = 350
# An auction with more users keeps them in the map. Each access to a state variable is a call from Python to the JVM.
USERS_IN_VALUE = 64
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

# What the state of an auction holds beside the map of its users; `recent` has the latest user last.
_HEAD = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("n_bids", T.LongType()),
        T.StructField("last_bid", T.LongType()),
        T.StructField("sl", T.LongType()),
        T.StructField("is_live", T.BooleanType()),
        T.StructField("complete", T.BooleanType()),
        T.StructField("n_users", T.LongType()),
        T.StructField("i_bid", T.BooleanType()),
        T.StructField("recent", T.ArrayType(T.StringType())),
        T.StructField("numbers", T.ArrayType(T.LongType())),
    ]
)
_USER = T.StructType([T.StructField("username", T.StringType())])
_NUMBERS = T.StructType([T.StructField(c, T.LongType()) for c in ("bid", "bids", "boms", "streak", "bom")])
_WIDTH = len(_NUMBERS)


class _Head:
    """The value of one auction while a trigger's messages are taken."""

    def __init__(self, kept: tuple | None) -> None:
        seq, n, last, sl, live, done, users, mine, recent, numbers = kept or (-1, 0, 0, FIRST_SECONDS_LEFT, False, False, 0, False, [], [])
        self.seq, self.n, self.last, self.sl, self.live, self.complete = int(seq), int(n), int(last), int(sl), bool(live), bool(done)
        self.users, self.mine = int(users), bool(mine)
        # Latest last: all users, or beside a map one more than are shown, as one of them may be me.
        self.recent = {u: tuple(numbers[i * _WIDTH : (i + 1) * _WIDTH]) for i, u in enumerate(recent)}

    @property
    def mapped(self) -> bool:
        """Whether the users are in the map."""
        return self.users > USERS_IN_VALUE

    def kept(self) -> tuple:
        shown = {} if self.complete else self.recent
        flat = [x for v in shown.values() for x in v]
        return (
            self.seq, self.n, self.last, self.sl, self.live, self.complete, self.users, self.mine, list(shown), flat,
        )

    def bid(self, user: str, bid: int, bom: bool, before: tuple | None, me: str) -> dict[str, tuple]:
        """Take a bid that follows on; the entries that it changes in the map."""
        _, bids, boms, streak, _ = before or (0, 0, 0, 0, 0)
        was_mapped = self.mapped
        self.users += before is None
        self.mine |= user == me
        self.n, self.last = self.n + 1, bid
        self.recent.pop(user, None)
        self.recent[user] = (bid, bids + 1, boms + bom, streak + 1 if bom else 0, int(bom))
        if not self.mapped:
            return {}
        changed = {user: self.recent[user]} if was_mapped else dict(self.recent)
        while len(self.recent) > OPPONENTS + 1:
            del self.recent[next(iter(self.recent))]
        return changed

    def row(self, auction_id: str, me: str, my_bid: int | None = None) -> Row:
        others = islice(((u, v) for u, v in reversed(self.recent.items()) if u != me), OPPONENTS)
        shown = [
            {"username": u, "bid": v[0], "is_bidomatic": bool(v[4]), "bids_so_far": v[1], "bom_bids_so_far": v[2], "bom_streak": v[3]}
            for u, v in others
        ]
        last_user = next(reversed(self.recent), None)
        return Row(*OUT.names)(
            auction_id, self.seq, self.n, self.last if self.n else None, last_user, self.sl, self.live, self.complete,
            self.users - self.mine, shown, my_bid,
        )


OUT = T.StructType([*LIVE_STATE.fields, T.StructField("my_bid", T.IntegerType())])


class Tracker(StatefulProcessor):
    """Takes the parsed messages of one auction in the order of `seq`."""

    def __init__(self, me: str, every: bool, idle_ms: int | None) -> None:
        self.me, self.every, self.idle_ms = me, every, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("auction", _HEAD)
        self.users = handle.getMapState("users", _USER, _NUMBERS)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        auction_id = key[0]
        kept = self.head.get()
        fresh, head = kept is None, _Head(kept)
        if head.complete:
            return
        touched: dict[str, tuple] = {}
        out, start = [], (head.n, head.live)
        for seq, kind, sl, bh in sorted(((r["seq"], r["kind"], r["sl"], r["bh"]) for r in rows), key=lambda m: m[0]):
            if seq <= head.seq:
                continue  # late or repeated: a later message has been taken already
            head.seq, was = seq, (head.n, head.live)
            if kind == "complete":
                head.complete = True
                break
            if kind == "live":
                head.live = True
            else:
                if sl is not None:  # a message without a countdown leaves the last one
                    head.sl = sl
                self._take(head, [] if bh is None else bh, touched, out, auction_id)
            if self.every and (head.n, head.live) != was:
                out.append(head.row(auction_id, self.me))
        changed = (head.n, head.live) != start or head.n == 0 or fresh
        if head.complete or (changed and not self.every):
            out.append(head.row(auction_id, self.me))
        self._keep(head, touched, timerValues)
        yield from out

    def _take(self, head: _Head, events, touched: dict, out: list, auction_id: str) -> None:
        """Bids of one message, oldest first, as far as they follow on."""
        for event in reversed(events):
            if event is None or event["id"] is None or event["u"] is None:
                continue
            bid, user = event["id"], event["u"]
            if head.n and bid != head.last + 1:
                continue
            if user == self.me and head.n:
                out.append(head.row(auction_id, self.me, bid))
            touched.update(head.bid(user, bid, event["t"] == 2, self._numbers(head, touched, user), self.me))

    def _numbers(self, head: _Head, touched: dict, user: str) -> tuple | None:
        known = touched.get(user) or head.recent.get(user)
        if known is None and head.mapped:
            known = self.users.getValue((user,))
        return known

    def _keep(self, head: _Head, touched: dict, timers) -> None:
        """Write the value and the users touched; of a complete auction only the mark stays."""
        self.head.update(head.kept())
        if head.complete:
            if head.mapped:
                self.users.clear()
        else:
            for user, numbers in touched.items():
                self.users.updateValue((user,), numbers)
        if self.idle_ms:
            for expiry in list(self.handle.listTimers()):
                self.handle.deleteTimer(expiry)
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.idle_ms)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Forget an auction that nothing has been heard of for long."""
        self.head.clear()
        self.users.clear()
        return iter(())

    def close(self) -> None:
        pass


def tracked_states(parsed: DataFrame, me: str, every: bool = False, idle_ms: int | None = None) -> DataFrame:
    """The columns of LIVE_STATE and `my_bid`: null for a state after messages, a number for the state just before that bid of mine.

    Messages are taken by `seq`; one at or before the last taken `seq` is
    ignored, and so is everything after the sold mark, in the same trigger or a
    later one. A bid is appended only if it follows the last one, so repeats
    and late bids drop and a gap freezes the list. A message without countdown
    or bid history changes what it has. `every` sends a row after each message
    that changes bids or live flag instead of once per trigger; `idle_ms`
    forgets auctions that never complete, and the marks of those that did; its
    timers need a query that goes on, not one that ends with what has arrived.
    """
    # This kind of state needs a store that holds many variables.
    parsed.sparkSession.conf.set(PROVIDER, ROCKS)
    return (
        parsed.select("auction_id", "seq", "kind", "sl", "bh")
        .groupBy("auction_id")
        .transformWithState(Tracker(me, every, idle_ms), OUT, "Update", "ProcessingTime" if idle_ms else "None")
    )
