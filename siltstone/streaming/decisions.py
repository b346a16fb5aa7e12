"""The decision state machine on a stream of openings and verbs."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from siltstone.operators.delivery import EXPIRY_ACTOR

# Times are microseconds, so no clock of a worker has a part in them.
STATE = "action_type string, expires_at long, status string, actor_id string, reason string, decided_at long"
EARLY = "event_id long, verb string, actor_id string, reason string, reasoned boolean, admits string, at long"
OUTPUT = "decision_id string, status string, actor_id string, reason string, decided_at long"
_Verb = Row("event_id", "verb", "actor_id", "reason", "reasoned", "admits", "at")
_Settled = Row("decision_id", "status", "actor_id", "reason", "decided_at")
# Verbs without a decision that are held before they are put into list state.
_WAITING = 1000


class DecisionProcessor(StatefulProcessor):
    """Keeps one small state row per decision, and verbs that came before their decision was opened.

    The first effective verb of a pending decision settles it; rows of a settled one are passed over after one
    look at its state. Rows of a micro-batch are folded one by one to the earliest effective one, so a busy
    decision needs no more memory than a quiet one. Early verbs wait in list state until the opening arrives,
    which then takes them all into account. An event-time timer expires a decision nobody answered.
    """

    def __init__(self, actions: Sequence[str]) -> None:
        self.place = {action: i for i, action in enumerate(actions)}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("decision", STATE)
        self.early = handle.getListState("early", EARLY)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self._open(initialState["action_type"], initialState["expires_at"])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held, opening, winner, waiting = self.state.get(), None, None, []
        if held is not None and held[2] != "pending":
            return
        for row in rows:
            if row["opening"]:
                if opening is None or _moment(row) < _moment(opening):
                    opening = row
            elif held is not None:
                winner = self._earlier(winner, row, held)
            else:
                waiting.append(tuple(row[name] for name in _Verb))
                if len(waiting) == _WAITING:
                    self.early.appendList(waiting)
                    waiting = []
        opened = held is None and opening is not None
        if opened:
            held = self._open(opening["action_type"], opening["expires_at"])
            stored = self.early.exists()
            for verb in chain(self.early.get() if stored else (), waiting):
                winner = self._earlier(winner, _Verb(*verb), held)
            if stored:
                self.early.clear()
        elif held is None:
            if waiting:
                self.early.appendList(waiting)
            return
        action, expires_at = held[:2]
        if winner is not None:
            expired = _passed(expires_at, winner["at"])
            yield self._settle(key, action, expires_at, "expired" if expired else winner["verb"], winner["actor_id"], None if expired else winner["reason"], winner["at"])
        elif opened and expires_at is not None and expires_at // 1000 <= timerValues.getCurrentWatermarkInMs():
            yield self._settle(key, action, expires_at, "expired", EXPIRY_ACTOR, None, expires_at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        action, expires_at, status, *_ = self.state.get()
        if status == "pending":
            yield self._settle(key, action, expires_at, "expired", EXPIRY_ACTOR, None, expires_at)

    def _open(self, action: str, expires_at: int | None) -> tuple:
        held = (action, expires_at, "pending", None, None, None)
        self.state.update(held)
        if expires_at is not None:
            self.handle.registerTimer(expires_at // 1000)
        return held

    def _earlier(self, winner: Row | None, verb: Row, held: tuple) -> Row | None:
        """The earlier of two verbs, if the second is of an admitted actor; a rejection without a reason only counts once
        the deadline has passed."""
        place = self.place.get(held[0])
        if place is None or verb["admits"][place] != "1" or not (verb["reasoned"] or _passed(held[1], verb["at"])):
            return winner
        return verb if winner is None or _turn(verb) < _turn(winner) else winner

    def _settle(self, key, action, expires_at, status, actor, reason, at) -> Row:
        self.state.update((action, expires_at, status, actor, reason, at))
        if expires_at is not None:
            self.handle.deleteTimer(expires_at // 1000)
        return _Settled(key[0], status, actor, reason, at)

    def close(self) -> None:
        pass


def _passed(expires_at: int | None, at: int) -> bool:
    return expires_at is not None and at >= expires_at


def _turn(verb: Row) -> tuple:
    return verb["at"], verb["event_id"] is None, verb["event_id"] or 0


def _moment(opening: Row) -> tuple:
    return opening["at"], opening["expires_at"] is None, opening["expires_at"] or 0


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def admitted(groups: Column, policy: Mapping[str, Sequence[str]]) -> Column:
    """One sign per action of the policy, in their order: 1 where a group may decide on it."""
    held = F.coalesce(groups, F.array().cast("array<string>"))
    signs = [F.when(F.arrays_overlap(held, F.array(*[F.lit(g) for g in policy[a]]).cast("array<string>")), "1").otherwise("0") for a in sorted(policy)]
    return F.concat(F.lit(""), *signs)


def decision_rows(events: DataFrame, openings: DataFrame | None, policy: Mapping[str, Sequence[str]]) -> DataFrame:
    """Verbs and openings as rows of one kind; ``counts`` marks those that may ever have an effect."""
    verbs = events.select(
        "decision_id", F.lit(False).alias("opening"), F.col("event_id").cast("long").alias("event_id"), "verb", "actor_id", "reason",
        ((F.col("verb") == "approved") | (F.coalesce("reason", F.lit("")) != "")).alias("reasoned"), admitted(F.col("actor_groups"), policy).alias("admits"), "ts", _micros("ts").alias("at"),
    )
    known = F.coalesce(F.col("verb").isin("approved", "rejected"), F.lit(False))
    typed = verbs.withColumn("counts", known & F.col("admits").contains("1")).withColumn("action_type", F.lit(None).cast("string")).withColumn("expires_at", F.lit(None).cast("long"))
    if openings is None:
        return typed
    opened = openings.select("decision_id", F.lit(True).alias("opening"), F.lit(True).alias("counts"), F.col("opened_at").alias("ts"), _micros("opened_at").alias("at"), "action_type", _micros("expires_at").alias("expires_at"))
    return typed.unionByName(opened, allowMissingColumns=True)


def decision_stream(
    events: DataFrame,
    decisions: DataFrame | None,
    policy: Mapping[str, Sequence[str]],
    delay: str = "1 hour",
    openings: DataFrame | None = None,
) -> DataFrame:
    """Settled decisions as a stream.

    ``events`` (stream): event_id, decision_id, verb, actor_id, actor_groups, reason, ts;
    ``decisions`` (table): decision_id, action_type, expires_at of the decisions pending at the start, which
    Spark hands to Python one Arrow batch each, so let many of them come as openings instead (None: none);
    ``openings`` (stream): the same columns and opened_at of decisions opened later. An opening may come
    after verbs of its decision, in other micro-batches too; only the first opening counts. ``delay``
    covers how far rows of either stream may lie behind the newest of both.
    """
    known = None if decisions is None else decisions.select("decision_id", "action_type", _micros("expires_at").alias("expires_at")).groupBy("decision_id")
    settled = (
        decision_rows(events, openings, policy)
        .withWatermark("ts", delay)
        # any event moves the time on: a condition on ts is not pushed below the watermark
        .where(F.when(F.col("ts").isNotNull(), F.col("counts")))
        .groupBy("decision_id")
        .transformWithState(DecisionProcessor(sorted(policy)), OUTPUT, "Append", "EventTime", initialState=known)
    )
    return settled.withColumn("decided_at", F.timestamp_micros("decided_at"))
