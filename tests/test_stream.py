import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import event, events, rows, state
from walrill import admin
from walrill.operators import envelope
from walrill.sources import files, replication
from walrill.streaming.store import Store
from walrill.streaming.stream import Writer, start

AGES = {"id": ("text", False, True), "age": ("bigint", False, False)}


def txn(first, txid, lsn, ages):
    return [event(first + i, f"{lsn}:{i + 1}", "insert", lsn, {"id": k}, {"id": k, "age": a}, txid=txid, sequence=i + 1, count=len(ages)) for i, (k, a) in enumerate(ages)]


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, f"{tmp_path}/store", buckets=4)
    s.commit(state(spark, **AGES))
    return s


def test_stream_survives_a_crash_before_offsets_are_noted(spark, tmp_path, store):
    source, checkpoint = f"{tmp_path}/in", f"{tmp_path}/checkpoint"
    first = txn(0, 1, "0/1", [("1", "10"), ("2", "oops")]) + txn(2, 2, "0/2", [("3", "30"), ("4", "40"), ("5", "50")])[:2]
    files.write_records(events(spark, first).coalesce(1), source)
    reports = []
    writer = Writer(spark, store, on_commit=reports.append)

    def crash(batch_df, batch):
        writer(batch_df, batch)
        raise RuntimeError("after the commit")

    with pytest.raises(Exception, match="after the commit"):
        files.stream_records(spark, source).writeStream.foreachBatch(crash).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    version = store.pointer()["version"]
    start(files.stream_records(spark, source), writer, checkpoint, available_now=True).awaitTermination()
    assert store.pointer()["version"] == version and len(reports) == 1
    assert rows(store.load().rows) == {"id=1": {"id": "1", "age": "10"}}
    # The rest of the open transaction, with what was sent of it before, and a broken document.
    files.write_records(events(spark, txn(4, 2, "0/2", [("3", "30"), ("4", "40"), ("5", "50")])).coalesce(1), source)
    spark.createDataFrame([(9, "k", "{broken")], files.RECORD).coalesce(1).write.mode("append").json(source)
    start(files.stream_records(spark, source), writer, checkpoint, available_now=True).awaitTermination()
    after = store.load()
    assert sorted(rows(after.rows)) == ["id=1", "id=3", "id=4", "id=5"] and after.markers.count() == 5
    assert sorted(r["event_id"] for r in after.dead_letters.collect()) == ["0/1:2", "offset:9"]


def test_store_commits_all_or_nothing(spark, store):
    s, pointer = store.load(), store.pointer()
    store.commit(s, batch=3)
    assert store.pointer()["batch"] == 3
    with pytest.raises(RuntimeError, match="another writer"):
        store.commit(s, expected=pointer["version"])


def test_upkeep_of_the_store(spark, store):
    from walrill.operators.apply import applied

    for n in range(5):
        s, pointer = store.load(), store.pointer()
        after, _, new = applied(events(spark, [event(n, f"e{n}", "insert", f"0/{n + 1}", {"id": str(n)}, {"id": str(n), "age": "1"})]), s, F.lit("2024-01-01").cast("timestamp"))
        store.commit(after, n, None, pointer["version"], new.select("id", F.col("lsn").cast("decimal(20,0)").alias("lsn")))
    assert store.compact_markers(most=3) == store.pointer()["version"] and store.compact_markers(most=3) is None
    before = (rows(store.load().rows), sorted(r["id"] for r in store.load().markers.collect()))
    assert before[1] == [f"e{n}" for n in range(5)] and len(store.vacuum(keep=1)) > 4 and store.vacuum(keep=1) == []
    assert (rows(store.load().rows), sorted(r["id"] for r in store.load().markers.collect())) == before
    assert set(rows(store.load(buckets=[0]).rows)) < set(before[0])


def test_admin(spark, store, tmp_path):
    from walrill.operators.apply import apply_batch

    bad = [event(1, "x", "insert", "0/1", {"id": "1"}, {"id": "1", "age": "oops"}), event(2, "y", "insert", "0/1", {"id": "2"}, {"id": "2", "age": "oops"}, ["note"])]
    store.commit(apply_batch(events(spark, bad), store.load(), F.lit("2024-01-01").cast("timestamp"))[0])
    call = lambda *a: admin.run(spark, admin.parse([*a, "--store", store.path]))
    status, text = call("list", "-table", "public.t")
    assert status == 0 and "x  op=insert  public.t  lsn=0/1" in text and "unchanged: note" in text
    assert json.loads(call("list", "--json", "--event", "x")[1])["event_id"] == "x"
    assert call("replay", "--all") == (1, "replayed 0, failed 2: x, y")
    assert call("drop", "--event", "x") == (0, "dropped x") and call("drop", "--event", "x")[0] == 1
    assert call("drop", "--all") == (0, "dropped 1 dead letters") and call("list") == (0, "no dead letters")
    for wrong in ([], ["purge"], ["replay"], ["drop", "--event", "x", "--all"], ["list", "--nonsense"]):
        with pytest.raises(admin.UsageError):
            admin.parse(wrong)


def test_replication_source(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    write = lambda first, last: (feed / replication.segment_name(first)).write_text("".join(json.dumps({"lsn": f"0/{n:X}", "kind": "insert"}) + "\n" for n in range(first, last)))
    write(1, 20)
    write(20, 31)
    replication.register(spark)
    reader = replication.ReplicationReader({"path": str(feed), "startLsn": "0/5", "acknowledge": "true"})
    assert reader.initialOffset() == {"lsn": 5} and reader.latestOffset() == {"lsn": 30}
    out = f"{tmp_path}/out"

    def go():
        spark.readStream.format("replication").option("path", str(feed)).option("startLsn", "0/5").load().writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
        return sorted(r["lsn"] for r in spark.read.parquet(out).collect())

    assert go() == list(range(6, 31))
    write(31, 40)
    assert go() == list(range(6, 40))
    reader.commit({"lsn": 25})
    assert [p.name for p in sorted(feed.iterdir())] == [replication.segment_name(20), replication.segment_name(31)]


def test_records_round_trip(spark):
    e = events(spark, [event(1, "a", "truncate", "0/1"), event(2, "b", "insert", "0/1", {"id": "1"}, {"id": "1", "x": None})])
    records = envelope.to_records(e, ("pos",))
    values = {r["pos"]: json.loads(r["value"]) for r in records.collect()}
    assert values[1]["key"] is None and "after" not in values[1] and values[2]["after"] == {"id": "1", "x": None}
    good, bad = envelope.from_records(records, ("pos",))
    assert bad.isEmpty() and {r["pos"]: r["after"] for r in good.collect()} == {1: None, 2: {"id": "1", "x": None}}
