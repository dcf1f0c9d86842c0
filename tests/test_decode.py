from tests.helpers import AT
from walrill.operators import assemble, decode, identity

COLUMNS = [("id", 1), ("name", 0), ("bio", 0)]


def msg(pos, kind, **v):
    fields = [f.split()[0] for f in decode.MESSAGE.split(", ")]
    fields = ["pos", "kind", "xid", "relation_id", "namespace", "relation", "columns", "old_kind", "old_tuple", "new_tuple", "relation_ids", "commit_lsn", "end_lsn", "commit_time"]
    return tuple({"pos": pos, "kind": kind, **v}.get(f) for f in fields)


def rel(pos, id=1, name="t", columns=COLUMNS):
    return msg(pos, "relation", relation_id=id, namespace="public", relation=name, columns=columns)


def t(*values):
    """Cells: text, None for null, ... for unchanged."""
    return [("u", None) if v is ... else ("n", None) if v is None else ("t", v) for v in values]


def begin(pos, xid=7):
    return msg(pos, "begin", xid=xid)


def commit(pos, lsn="0/100"):
    return msg(pos, "commit", commit_lsn=lsn, end_lsn=lsn, commit_time=AT)


def run(spark, rows, keys=None):
    ident = spark.createDataFrame(keys, "`schema` string, `table` string, key_columns array<string>") if keys else None
    events, faults = decode.decode(spark.createDataFrame(rows, decode.MESSAGE), ident)
    got = [(r["id"], r["operation"], dict(r["key"]) if r["key"] else None, dict(r["after"]) if r["after"] else None, list(r["unchanged_columns"]), r["source"]["transaction_event_count"]) for r in events.orderBy("commit_pos", "source.sequence").collect()]
    return got, sorted((r["pos"], r["reason"]) for r in faults.collect())


def test_committed_changes_only(spark):
    m = [rel(0), begin(1), msg(2, "insert", relation_id=1, new_tuple=t("1", "a", None)), msg(3, "update", relation_id=1, new_tuple=t("1", "b", ...)), msg(4, "delete", relation_id=1, old_kind="K", old_tuple=t("1", None, None)), commit(5)]
    m += [msg(6, "origin"), begin(7), msg(8, "insert", relation_id=1, new_tuple=t("2", "x", "y"))]
    events, faults = run(spark, m)
    assert events == [("0/100:1", "insert", {"id": "1"}, {"id": "1", "name": "a", "bio": None}, [], 3), ("0/100:2", "update", {"id": "1"}, {"id": "1", "name": "b"}, ["bio"], 3), ("0/100:3", "delete", {"id": "1"}, None, [], 3)]
    assert faults == []


def test_key_change_toast_and_truncate(spark):
    m = [rel(0), rel(1, 2, "u"), begin(2)]
    m += [msg(3, "update", relation_id=1, old_kind="O", old_tuple=t("1", "old", "bio"), new_tuple=t("2", "new", ...)), msg(4, "update", relation_id=1, old_kind="O", old_tuple=t("3", "old", None), new_tuple=t("3", ..., ...)), msg(5, "truncate", relation_ids=[1, 2]), commit(6)]
    events, faults = run(spark, m)
    assert [e[:5] for e in events] == [
        ("0/100:1", "delete", {"id": "1"}, None, []), ("0/100:2", "insert", {"id": "2"}, {"id": "2", "name": "new", "bio": "bio"}, []),
        ("0/100:3", "update", {"id": "3"}, {"id": "3", "name": "old"}, ["bio"]), ("0/100:4", "truncate", None, None, []), ("0/100:5", "truncate", None, None, []),
    ]
    assert faults == []


def test_identity_overrides_flags_and_latest_description_wins(spark):
    full = [("id", 1), ("email", 1)]
    m = [rel(0, columns=full), begin(1), msg(2, "update", relation_id=1, old_kind="O", old_tuple=t("1", "a"), new_tuple=t("1", "b")), commit(3), rel(4, columns=[*full, ("extra", 0)]), begin(5), msg(6, "insert", relation_id=1, new_tuple=t("2", "c", "d")), commit(7, "0/200")]
    events, faults = run(spark, m, [("public", "t", ["id"])])
    assert [(e[0], e[1], e[2]) for e in events] == [("0/100:1", "update", {"id": "1"}), ("0/200:1", "insert", {"id": "2"})] and events[1][3]["extra"] == "d" and faults == []


def test_faults_stop_their_transaction_only(spark):
    m = [rel(0), commit(1), msg(2, "insert", relation_id=1, new_tuple=t("1", "a", "b")), begin(3), begin(4), msg(5, "insert", relation_id=9, new_tuple=t("1", "a", "b")), commit(6), begin(7), msg(8, "insert", relation_id=1, new_tuple=t("1", "a", ...)), commit(9), begin(10), msg(11, "insert", relation_id=1, new_tuple=t("5", "a", "b")), commit(12, "0/300")]
    events, faults = run(spark, m)
    assert [e[0] for e in events] == ["0/300:1"]
    assert faults == [(1, "commit without a transaction"), (2, "change outside a transaction"), (4, "begin inside a transaction"), (5, "relation not described"), (8, "insert with unchanged values")]


def test_moved_key_needs_the_old_value(spark):
    m = [rel(0), begin(1), msg(2, "update", relation_id=1, old_kind="O", old_tuple=t("1", "a", None), new_tuple=t("2", "a", ...)), commit(3)]
    assert run(spark, m) == ([], [(2, "unchanged value without an old image while the key changes")])


def test_identity_rules(spark):
    tables = spark.createDataFrame([("d", ["id"], None), ("i", ["id"], ["email"]), ("f", ["id"], None), ("f", None, ["email"]), ("n", ["id"], None), ("x", ["id"], None)], "mode string, primary_key array<string>, index_columns array<string>")
    got = [(r["mode"], r["key_columns"], r["refusal"]) for r in identity.resolve(tables).collect()]
    assert got == [("d", ["id"], None), ("i", ["email"], None), ("f", ["id"], None), ("f", None, "no usable key"), ("n", None, "identity nothing"), ("x", None, "unknown identity")]


def test_assembly_holds_back_what_is_not_whole(spark):
    e = spark.createDataFrame([(1, 1, "0/1", 1, 2), (2, 1, "0/1", 1, 2), (3, 1, "0/1", 2, 2), (4, 2, "0/2", 1, 3), (5, 2, "0/2", 3, 3)], "pos long, transaction_id long, commit_lsn string, sequence int, transaction_event_count int")
    ready, waiting = assemble.split_complete(e)
    assert sorted(r["pos"] for r in ready.collect()) == [1, 2, 3] and sorted(r["pos"] for r in waiting.collect()) == [4, 5]
    assert [(r["pos"], r["fault"]) for r in assemble.sequence_faults(e).collect()] == [(5, "gap")]
