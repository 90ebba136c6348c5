"""Slots that change state as events come and as time passes: the streaming twin of operators.slots."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vintora.operators.slots import DATED, ENDED, GRACE, LEAD, turn

DAY = 86_400_000
COLUMNS = ["slot_id", "at_ms", "step", "state", "due_ms", "poll_seconds"]


def steps(due: int, lead: int = LEAD, grace: int = GRACE) -> list[tuple[int, str, int]]:
    """(instant, state, seconds between polls) from which each rung of the ladder holds; instants in milliseconds, in order."""
    four_hours = due + 14_400_000
    midnight = max((due // DAY + 1) * DAY, four_hours)
    rungs = [(due - lead * 1000, "watching", 60), (due + 1_800_000, "watching", 300), (four_hours, "watching", 1800), (midnight, "watching", 21_600), (due + grace * 1000, "late", 0)]
    return [r for k, r in enumerate(rungs) if k == len(rungs) - 1 or r[0] < min(rungs[k + 1][0], rungs[-1][0])]


class SlotLife(StatefulProcessor):
    """One slot's state, its due instant and one timer, at the next rung of the ladder."""

    def __init__(self, lead: int = LEAD, grace: int = GRACE):
        self.lead, self.grace = lead, grace

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("slot", "state string, due long, since long, step long")

    def close(self) -> None:
        pass

    def _advance(self, slot: dict, until: int) -> Iterator[tuple]:
        """The rungs that time alone passes up to an instant."""
        if slot["due"] is None or slot["state"] not in (*DATED, "watching"):
            return
        for at, state, poll in steps(slot["due"], self.lead, self.grace):
            if slot["since"] < at <= until:
                slot |= {"state": state, "since": at, "step": slot["step"] + 1}
                yield at, slot["step"], state, slot["due"], poll

    def _apply(self, slot: dict, at: int, kind: str, due: int | None) -> Iterator[tuple]:
        """What an event makes of a slot."""
        state, poll = slot["state"], None
        if state in (*ENDED, "cancelled") or (state == "captured" and kind not in ENDED):
            return
        if kind in DATED and due is not None:
            passed = [r for r in steps(due, self.lead, self.grace) if r[0] <= at]
            state, poll = passed[-1][1:] if passed else (kind, None)
        elif kind in ("captured", *ENDED) or (kind in ("delayed", "cancelled") and state in ("late", "delayed")):
            state, due = kind, slot["due"]
        else:
            return
        slot |= {"state": state, "due": due, "since": at, "step": slot["step"] + 1}
        yield at, slot["step"], state, due, poll

    def _load(self) -> dict:
        if not self.held.exists():
            return {"state": None, "due": None, "since": 0, "step": 0}
        return dict(zip(("state", "due", "since", "step"), self.held.get()))

    def _keep(self, key, slot: dict, out: list[tuple]) -> Iterator[pd.DataFrame]:
        if slot["state"] is None:
            return
        self.held.update((slot["state"], slot["due"], slot["since"], slot["step"]))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if slot["due"] is not None and slot["state"] in (*DATED, "watching"):
            ahead = [r[0] for r in steps(slot["due"], self.lead, self.grace) if r[0] > slot["since"]]
            if ahead:
                self.handle.registerTimer(ahead[0])
        if out:
            rows = pd.DataFrame([(key[0], *o) for o in out], columns=COLUMNS)
            yield rows.astype({"due_ms": "Int64", "poll_seconds": "Int64"})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        slot, out = self._load(), []
        events = pd.concat(list(rows)).sort_values(["at_ms", "seq", "turn", "due_ms"])  # one slot's events of one batch
        for at, kind, due in zip(events["at_ms"], events["kind"], events["due_ms"]):
            out += self._advance(slot, int(at))
            out += self._apply(slot, int(at), kind, None if pd.isna(due) else int(due))
        yield from self._keep(key, slot, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        slot = self._load()
        yield from self._keep(key, slot, list(self._advance(slot, int(timerValues.getCurrentWatermarkInMs()))))


def slot_life(events: DataFrame, late: str = "1 day", lead: int = LEAD, grace: int = GRACE) -> DataFrame:
    """A stream of slot_id, at, step, state, due, poll_seconds: every change of every slot, numbered within it.

    events: a stream of slot_id, at (timestamp), seq, kind, due, with the meaning they have in operators.slots.life.
    Event-time timers move slots that no event comes for; the state is a row and a timer for each slot. Events later than
    `late` are dropped, rows without a slot as well. The session needs the RocksDB state store.
    """
    key = dict(events.dtypes)["slot_id"]
    rows = events.where("slot_id IS NOT NULL AND at IS NOT NULL").withWatermark("at", late)
    rows = rows.select("slot_id", "at", F.unix_millis("at").alias("at_ms"), F.col("seq").cast("long").alias("seq"), "kind", turn(F.col("kind")).alias("turn"), F.unix_millis(F.col("due").cast("timestamp")).alias("due_ms"))
    out = rows.groupBy("slot_id").transformWithStateInPandas(SlotLife(lead, grace), f"slot_id {key}, at_ms long, step long, state string, due_ms long, poll_seconds long", "Append", "EventTime")
    return out.select("slot_id", F.timestamp_millis("at_ms").alias("at"), "step", "state", F.timestamp_millis("due_ms").alias("due"), F.col("poll_seconds").cast("int").alias("poll_seconds"))
