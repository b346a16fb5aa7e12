import json

from pyspark.sql import functions as F

from siltstone.operators import telemetry
from siltstone.plans.declared import CONTRACTS
from siltstone.sources.lake import read_bronze, read_dlq, read_ledger
from siltstone.sources.topics import file_stream
from siltstone.streaming.decisions import DecisionProcessor, decision_stream
from siltstone.streaming.ingest import append_stream, ingest_stream
from siltstone.streaming.outbox import outbox_stream, read_outbox

QUOTES = CONTRACTS["b3_quotes"]
EVENT = "event_id long, decision_id string, verb string, actor_id string, actor_groups array<string>, reason string, ts timestamp"


def drop(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def quote(ticker):
    return json.dumps({"ticker": ticker, "price": 1.0, "quote_timestamp": "t"})


def test_ingest_resumes_and_replays(spark, tmp_path):
    source, root, checkpoint = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "cp")

    def run():
        ingest_stream(file_stream(spark, str(source), 1), QUOTES, root, checkpoint).awaitTermination()

    drop(source, "1.json", [quote("A"), quote(None), "{broken", ""])
    drop(source, "2.json", [quote("B")])
    run()
    run()  # nothing new
    drop(source, "3.json", [quote("C")])
    run()
    assert sorted(r["ticker"] for r in read_bronze(spark, root, QUOTES).collect()) == ["A", "B", "C"]
    assert sorted(r["_failure_reason"] for r in read_dlq(spark, root).collect()) == ["malformed_json", "null_violation:ticker"]
    # A batch whose commit was lost is run again and replaces its own rows.
    last = max((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (tmp_path / "cp" / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    run()
    assert read_bronze(spark, root, QUOTES).count() == 3
    assert read_ledger(spark, root).agg(F.sum("rows")).first()[0] == 5  # accepted and refused, counted once


def test_another_checkpoint_leaves_the_first_streams_rows(spark, tmp_path):
    root = str(tmp_path / "lake")
    for name in ("A", "B"):  # both number their batches from 0, on the same day
        drop(tmp_path / name, "1.json", [quote(name), quote(None)])
        for _ in range(2):
            ingest_stream(file_stream(spark, str(tmp_path / name), 1), QUOTES, root, str(tmp_path / f"cp-{name}")).awaitTermination()
    assert sorted(r["ticker"] for r in read_bronze(spark, root, QUOTES).collect()) == ["A", "B"]
    assert read_dlq(spark, root).count() == 2 and read_ledger(spark, root).select("batch").distinct().count() == 2


def event(i, decision, verb, at, groups=("g",), reason=None):
    return json.dumps(
        {"event_id": i, "decision_id": decision, "verb": verb, "actor_id": f"a{i}", "actor_groups": list(groups), "reason": reason, "ts": at}
    )


def test_decision_machine_over_several_batches(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    decisions = spark.createDataFrame(
        [(d, "act", "2026-01-01 12:00:00") for d in ("d1", "d2", "d3", "d4")] + [("d5", "act", "2026-06-01 00:00:00")],
        "decision_id string, action_type string, expires_at string",
    ).withColumn("expires_at", F.col("expires_at").cast("timestamp"))
    batches = [
        [
            event(1, "d1", "rejected", "2026-01-01T10:00:00Z"),  # no reason
            event(2, "d2", "approved", "2026-01-01T10:00:00Z", groups=("x",)),  # not admitted
            event(9, "dx", "approved", "2026-01-01T10:00:00Z"),  # unknown decision
        ],
        [
            event(3, "d1", "rejected", "2026-01-01T10:06:00Z", reason="no"),
            event(4, "d1", "approved", "2026-01-01T10:05:00Z"),  # earlier, later in the file
            event(5, "d3", "approved", "2026-01-01T12:00:00Z"),  # at the deadline
        ],
        [event(6, "d1", "rejected", "2026-01-01T10:07:00Z", reason="late")],
        [event(7, "d5", "noted", "2026-01-02T10:00:00Z")],
    ]
    for n, lines in enumerate(batches):
        drop(source, f"{n}.json", lines)
        stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).json(str(source))
        settled = decision_stream(stream, decisions, {"act": ["g"]})
        append_stream(settled, out, str(tmp_path / "cp")).awaitTermination()
    got = {r["decision_id"]: (r["status"], r["actor_id"]) for r in spark.read.parquet(out).collect()}
    assert spark.read.parquet(out).count() == len(got)
    assert got == {
        "d1": ("approved", "a4"),
        "d3": ("expired", "a5"),
        "d2": ("expired", "system:expiry"),
        "d4": ("expired", "system:expiry"),
    }


def test_decisions_opened_on_the_stream_meet_verbs_that_came_before(spark, tmp_path):
    out = str(tmp_path / "out")
    opening = "decision_id string, action_type string, expires_at timestamp, opened_at timestamp"
    noon = "2026-01-01T12:00:00Z"
    batches = [  # verbs, openings
        ([event(1, "d1", "approved", "2026-01-01T10:30:00Z"), event(2, "d1", "rejected", "2026-01-01T10:20:00Z", reason="r"),
          event(3, "d2", "approved", "2026-01-01T10:00:00Z", groups=("x",)), event(4, "d4", "rejected", "2026-01-01T10:00:00Z")], []),
        ([event(5, "d1", "approved", "2026-01-01T10:10:00Z"), event(6, "d9", "approved", "2026-01-01T10:00:00Z")],
         [("d1", "act", noon), ("d2", "act", noon), ("d4", "act", noon), ("d5", "other", noon)]),
        ([event(7, "d2", "approved", "2026-01-01T11:00:00Z"), event(8, "d1", "rejected", "2026-01-01T09:59:00Z", reason="late"),
          event(9, "d5", "approved", "2026-01-01T11:00:00Z")], [("d2", "other", "2026-01-09T00:00:00Z")]),
        ([event(10, "d6", "noted", "2026-01-03T00:00:00Z"), event(11, "d6", "approved", "2026-01-03T00:00:00Z")], []),
    ]
    for n, (verbs, opened) in enumerate(batches):
        drop(tmp_path / "verbs", f"{n}.json", verbs)
        rows = [json.dumps({"decision_id": d, "action_type": a, "expires_at": e, "opened_at": "2026-01-01T10:30:00Z"}) for d, a, e in opened]
        drop(tmp_path / "openings", f"{n}.json", rows or [""])
        settled = decision_stream(
            spark.readStream.schema(EVENT).json(str(tmp_path / "verbs")), spark.createDataFrame([], "decision_id string, action_type string, expires_at timestamp"),
            {"act": ["g", "h"], "bet": ["x"]}, openings=spark.readStream.schema(opening).json(str(tmp_path / "openings")),
        )
        append_stream(settled, out, str(tmp_path / "cp")).awaitTermination()
    found = spark.read.parquet(out).collect()
    got = {r["decision_id"]: (r["status"], r["actor_id"]) for r in found}
    assert len(found) == len(got) == 4
    assert got == {
        "d1": ("approved", "a5"),  # the earliest of two early verbs and one that came with the opening
        "d2": ("approved", "a7"),  # the second opening changes nothing
        "d4": ("expired", "system:expiry"),  # a rejection without a reason
        "d5": ("expired", "system:expiry"),  # an action the policy does not know
    }


def test_rows_of_a_settled_decision_are_not_read():
    class Held:
        def get(self):
            return ("act", 1, "approved", "a1", None, 0)

    processor = DecisionProcessor(["act"])
    processor.state = Held()

    def rows():
        raise AssertionError("a row was read")
        yield

    assert list(processor.handleInputRows(("d1",), rows(), None)) == []


REQUEST = "idempotency_key string, n long, ts timestamp"


def test_outbox_never_forgets_a_key(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), tmp_path / "cp"

    def run():
        stream = spark.readStream.schema(REQUEST).option("maxFilesPerTrigger", 1).json(str(source))
        outbox_stream(stream, out, str(checkpoint), ["ts", "n"], buckets=4).awaitTermination()
        return sorted((r["idempotency_key"], r["n"]) for r in read_outbox(spark, out, REQUEST).collect())

    def send(name, *rows):
        drop(source, name, [json.dumps({"idempotency_key": k, "n": n, "ts": ts}) for k, n, ts in rows])

    send("1.json", ("k1", 2, "2026-01-01T00:00:00Z"), ("k1", 1, "2026-01-01T00:00:00Z"), ("k2", 3, "2026-01-01T01:00:00Z"))
    send("2.json", ("k1", 4, "2026-01-01T02:00:00Z"))
    assert run() == [("k1", 1), ("k2", 3)]
    send("3.json", ("k1", 5, "2026-03-02T00:00:00Z"), ("k3", 6, "2025-01-01T00:00:00Z"))  # after 60 days, and long before
    assert run() == run() == [("k1", 1), ("k2", 3), ("k3", 6)]
    last = max((checkpoint / "commits").glob("[0-9]*"), key=lambda p: int(p.name))  # the commit is lost: the batch is run again
    last.unlink()
    (checkpoint / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    assert run() == [("k1", 1), ("k2", 3), ("k3", 6)]
    hot = [("k1" if n % 3 == 0 else f"h{n}", 100 + n, "2026-04-01T00:00:00Z") for n in range(300)]
    send("4.json", *hot)
    assert len(run()) == 3 + 200


def test_rate_is_the_same_in_batch_and_stream(spark, tmp_path, rows):
    source, out = tmp_path / "in", str(tmp_path / "out")
    points = [{"ts": f"2026-01-01T00:{m:02d}:30Z", "domain": "d", "result": "ok", "amount": float(m)} for m in range(30)]
    drop(source, "1.json", [json.dumps(p) for p in points])
    drop(source, "2.json", [json.dumps({**points[0], "ts": "2026-01-01T05:00:00Z"})])
    schema = "ts timestamp, domain string, result string, amount double"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source)).withWatermark("ts", "10 minutes")
    rates = telemetry.rate(stream, ["domain", "result"])
    append_stream(rates, out, str(tmp_path / "cp")).awaitTermination()
    batch = telemetry.rate(spark.read.schema(schema).json(str(source)), ["domain", "result"])
    closed = batch.where("window_start < timestamp'2026-01-01 01:00:00'")
    assert rows(spark.read.parquet(out)) == rows(closed) and closed.count() == 6
