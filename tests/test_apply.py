import random
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import AT, Sequential, event, events, registry, rows, state
from walrill.operators import evolve, fold, quarantine, snapshot
from walrill.operators.apply import apply_batch

TEXT = {"id": ("text", False, True), "name": ("text", True, False), "bio": ("text", True, False)}
AGES = {"id": ("text", False, True), "age": ("bigint", False, False)}


@pytest.fixture
def stamp(spark):
    return F.lit("2024-01-01").cast("timestamp")


def outcomes(df):
    return {r["id"]: r["outcome"] for r in df.collect()}


def test_groups_with_repeats_stale_changes_and_truncates(spark, stamp):
    k = lambda n: {"id": str(n)}
    up = lambda n, name: {"id": str(n), "name": name}
    names = ((4, "ada"), (5, "bo"), (6, "cy"))
    log = [event(n, f"a:{n}", "insert", "0/A0", k(n), up(n, x)) for n, x in names] + [event(n + 20, f"a:{n}", "insert", "0/A0", k(n), up(n, x)) for n, x in names]
    log += [event(30, "b:1", "update", "0/B0", k(4), up(4, "adele"), ["bio"]), event(31, "b:2", "update", "0/B0", k(5), up(5, "bob")), event(32, "b:3", "update", "0/90", k(6), up(6, "late")), event(33, "b:4", "delete", "0/B0", k(6))]
    mid, _ = apply_batch(events(spark, log), state(spark, **TEXT), stamp)
    assert rows(mid.rows) == {"id=4": up(4, "adele"), "id=5": up(5, "bob")}
    log += [event(40, "c:1", "truncate", "0/C0"), event(41, "c:2", "insert", "0/C0", k(7), up(7, "di")), event(50, "d:1", "truncate", "0/BF"), event(51, "d:2", "insert", "0/D0", k(8), up(8, "eve"))]
    after, outcome = apply_batch(events(spark, log), state(spark, **TEXT), stamp)
    assert rows(after.rows) == {"id=7": up(7, "di"), "id=8": up(8, "eve")}
    assert [int(r["watermark"]) for r in after.watermarks.collect()] == [0xC0] and after.markers.count() == 11
    assert outcomes(outcome.where("outcome <> 'duplicate'"))["d:1"] == "stale truncate"
    assert {r["replicated_at"] for r in after.rows.collect()} == {AT}
    # The same log again changes nothing.
    again, second = apply_batch(events(spark, log), after, stamp)
    assert rows(again.rows) == rows(after.rows) and set(outcomes(second).values()) == {"duplicate"}


@pytest.mark.parametrize("seed", range(4))
def test_set_based_equals_sequential(spark, seed):
    r, log = random.Random(seed), []
    for p in range(60):
        op = r.choices(["upsert", "delete", "truncate"], [8, 2, 0.4])[0]
        late = r.choice([0, 0, 0, -60]) if seed % 2 else 0
        after = {c: r.choice([None, str(p)]) for c in r.sample("abc", r.randint(1, 3))} if op == "upsert" else None
        log.append((p, f"e{r.randint(0, 80)}", op, None if op == "truncate" else f"k{r.randint(0, 6)}", max(p * 10 + late, 0), after))
    base = {"k0": {"lsn": 55, "cols": {"a": "x", "z": None}}, "k9": {"lsn": None, "cols": {"a": "q"}}, "k1": {"lsn": None, "cols": {"b": "q"}}}
    model = Sequential(base, r.choice([0, 300]))
    mark = model.watermark
    schema = "pos long, id string, `schema` string, `table` string, operation string, key string, lsn decimal(20,0), commit_time timestamp, key_row map<string,string>, after map<string,string>"
    e = spark.createDataFrame([(p, i, "s", "t", op, k, Decimal(n), AT, None, a) for p, i, op, k, n, a in log], schema)
    b = spark.createDataFrame([("s", "t", k, None if v["lsn"] is None else Decimal(v["lsn"]), AT, v["cols"], None) for k, v in base.items()], fold.STATE)
    got, marks = fold.fold(fold.fresh(e), b, spark.createDataFrame([("s", "t", Decimal(mark))], fold.WATERMARKS))
    for _, i, op, k, n, a in log:
        model.apply(i, op, k, n, a)
    assert {x["key"]: {"lsn": None if x["lsn"] is None else int(x["lsn"]), "cols": dict(x["cols"])} for x in got.collect()} == model.rows
    assert {int(x["watermark"]) for x in marks.collect()} == {model.watermark}


def test_poison_is_set_aside_and_replayed(spark, stamp):
    log = [event(1, "a", "insert", "0/10", {"id": "1"}, {"id": "1", "age": "10"}), event(2, "b", "insert", "0/10", {"id": "2"}, {"id": "2", "age": "not-a-bigint"}), event(3, "c", "insert", "0/10", {"id": "3"}, {"id": "3", "age": "30"}), event(4, "d", "insert", "0/10", {"id": "4"}, {"id": "4"}), event(5, "e", "insert", "0/10", {"id": "5"}, {"id": "5", "age": "1", "x": "y"}), event(6, "f", "insert", "0/10", {"id": "6"}, {"id": "6", "age": "1"}, version=2)]
    after, outcome = apply_batch(events(spark, log), state(spark, **AGES), stamp)
    assert sorted(rows(after.rows)) == ["id=1", "id=3"] and after.markers.count() == 6
    reasons = {r["event_id"]: r["reason"] for r in after.dead_letters.collect()}
    assert reasons == {"b": "value refused by type age", "d": "required column missing age", "e": "undefined column x", "f": "unsupported version"}
    assert [r["event_id"] for r in quarantine.listed(after.dead_letters, "public", "t").collect()] == ["b", "d", "e", "f"]
    # Still refused: record and marker stay. Then the column becomes text.
    same, result = quarantine.replay(after, quarantine.one(after.dead_letters, "b"), F.lit("2024-03-03").cast("timestamp"))
    assert {r["occurred_at"] for r in same.dead_letters.collect()} == {AT}
    assert [tuple(r) for r in result.collect()] == [("b", False)] and same.dead_letters.count() == 4 and same.markers.count() == 6
    fixed = replace(after, registry=registry(spark, **AGES | {"age": ("text", False, False)}))
    healed, result = quarantine.replay(fixed, quarantine.one(after.dead_letters, "b"), stamp)
    assert [tuple(r) for r in result.collect()] == [("b", True)] and rows(healed.rows)["id=2"]["age"] == "not-a-bigint" and healed.dead_letters.count() == 3
    dropped = quarantine.drop(after, quarantine.one(after.dead_letters, "b"))
    assert dropped.dead_letters.count() == 3 and dropped.markers.where("id = 'b'").isEmpty()


def test_preserving_updates(spark, stamp):
    s = state(spark, id=("integer", False, True), name=("text", False, False), bio=("text", False, False))
    long = "x" * 12_000
    first, _ = apply_batch(events(spark, [event(1, "i", "insert", "0/2400000", {"id": "1"}, {"id": "1", "name": "n", "bio": long})]), s, stamp)
    log = [event(2, "u", "update", "0/2400100", {"id": "1"}, {"id": "1", "name": "renamed"}, ["bio"]), event(3, "k", "update", "0/2400100", {"id": "1"}, {"id": "1", "name": "z"}, ["id"]), event(4, "s", "update", "0/2400050", {"id": "1"}, {"id": "1", "name": "old"}, ["bio"]), event(5, "m", "update", "0/2400200", {"id": "77"}, {"id": "77", "name": "m"}, ["bio"])]
    after, outcome = apply_batch(events(spark, log), first, stamp)
    assert rows(after.rows) == {"id=1": {"id": "1", "name": "renamed", "bio": long}}
    assert outcomes(outcome) == {"u": "applied", "s": "applied", "k": "dead letter", "m": "dead letter"}


def test_repair_adds_what_the_source_has(spark, stamp):
    s = state(spark, id=("bigint", False, True), name=("text", False, False))
    s, _ = apply_batch(events(spark, [event(1, "i", "insert", "0/1", {"id": "1"}, {"id": "1", "name": "a"})]), s, stamp)
    source = registry(spark, id=("bigint", False, True), name=("text", False, False), mood=("mood", True, False, "ok", ["ok", "sad"]), tags=("text[]", True, False), shape=("box", True, False))
    e = events(spark, [event(2, "u", "update", "0/2", {"id": "1"}, {"id": "1", "name": "a", "mood": "sad", "tags": "{x,y}"}), event(3, "v", "insert", "0/2", {"id": "2"}, {"id": "2", "name": "b", "shape": "()"}), event(4, "w", "insert", "0/2", {"id": "3"}, {"id": "3", "name": "c", "mood": "angry"})])
    fixed, report = evolve.repair(s, source, e)
    assert {r["column"]: r["action"] for r in report.collect()} == {"mood": "added with enum", "tags": "added", "shape": "refused: type cannot be created"}
    assert rows(fixed.rows)["id=1"]["mood"] == "ok"
    after, outcome = apply_batch(e, fixed, stamp)
    assert rows(after.rows)["id=1"]["mood"] == "sad" and outcomes(outcome) == {"u": "applied", "v": "dead letter", "w": "dead letter"}
    assert evolve.repair(fixed, source, e.where("pos = 2"))[1].isEmpty()


def test_reserved_columns_of_keys_and_rows(spark, stamp):
    log = [event(1, "a", "delete", "0/1", {"id": "1", "replicated_at": "x"}), event(2, "b", "insert", "0/1", {"id": "2"}, {"id": "2", "source_lsn": "x"}), event(3, "c", "delete", "0/1", {"id": "3"})]
    after, outcome = apply_batch(events(spark, log), state(spark, **TEXT), stamp)
    assert outcomes(outcome) == {"a": "dead letter", "b": "dead letter", "c": "applied"} and {r["reason"] for r in after.dead_letters.collect()} == {"reserved column"}


def test_dead_letters_of_one_moment_replay_in_their_order(spark, stamp):
    log = [event(p, f"0/{lsn}:{s}", "insert", f"0/{lsn}", {"id": "1"}, {"id": "1", "age": f"x{p}"}) for p, (lsn, s) in enumerate([("9", 2), ("9", 10), ("A", 1)])]
    after, _ = apply_batch(events(spark, log), state(spark, **AGES), stamp)
    fixed = replace(after, registry=registry(spark, **AGES | {"age": ("text", False, False)}))
    healed, _ = quarantine.replay(fixed, after.dead_letters, stamp)
    assert rows(healed.rows)["id=1"]["age"] == "x2" and [r["id"] for r in quarantine.as_events(after.dead_letters).orderBy("pos").collect()] == ["0/9:2", "0/9:10", "0/A:1"]


def test_snapshot_and_boot(spark, stamp):
    s = state(spark, id=("bigint", False, True), score=("numeric(12,4)", True, False), extra=("text", True, False), flag=("boolean", True, False))
    source = spark.createDataFrame([(1, Decimal("12345.6789"), True), (2, None, False)], "id long, score decimal(12,4), flag boolean")
    with pytest.raises(snapshot.SnapshotError):
        snapshot.wait_for_position(lambda: None, timeout=0, every=0)
    done = snapshot.boot(s, lambda: "0/100", {("public", "t"): source}, stamp)
    assert snapshot.completed(done) and done.markers.isEmpty()
    assert rows(done.rows) == {"id=1": {"id": "1", "score": "12345.6789", "flag": "t"}, "id=2": {"id": "2", "score": None, "flag": "f"}}
    again = snapshot.run(done, {("public", "t"): source}, "0/100", stamp)
    assert rows(again.rows) == rows(done.rows)
    assert snapshot.boot(done, lambda: "0/1", {}, stamp) is done
    with pytest.raises(snapshot.SnapshotError):
        snapshot.boot(done, lambda: None, {}, stamp)
    with pytest.raises(snapshot.SnapshotError):
        snapshot.rows_of(source.drop("id"), "public", "t", ["score"], ["id"], "0/1", stamp)
    with pytest.raises(Exception, match="key column id is null"):
        snapshot.rows_of(spark.createDataFrame([(None, "x")], "id long, extra string"), "public", "t", ["id", "extra"], ["id"], "0/1", stamp).collect()
