"""The source side of the stream: transactions over several batches, crashes, repeated deliveries, upkeep."""

import json

import pytest

from tests.test_decode import begin, commit, msg, rel, t
from walrill.functions import retry
from walrill.operators import decode
from walrill.sources import replication
from walrill.streaming import observe, publish

FIELDS = [f.split()[0] for f in decode.MESSAGE.replace("<", " ").split(", ")]


def feed(spark, rows, extra=()):
    """Messages as (lsn, body), with bodies as a client would spool them."""
    df = spark.createDataFrame(rows, decode.MESSAGE)
    body = df.selectExpr("pos as lsn", f"to_json(struct({', '.join(c for c in df.columns if c != 'pos')})) as body")
    return body.unionByName(spark.createDataFrame(list(extra), "lsn long, body string")) if extra else body


def insert(pos, key):
    return msg(pos, "insert", relation_id=1, new_tuple=t(key, "a", None))


def published(p):
    return [(r["offset"], json.loads(r["value"])["id"], json.loads(r["value"])["key"]["id"]) for r in p.records().orderBy("offset").collect()]


def test_a_transaction_over_three_batches(spark, tmp_path):
    reports = []
    p = publish.Publisher(spark, f"{tmp_path}/out", on_commit=reports.append)
    p(feed(spark, [rel(1), begin(2), insert(3, "1"), commit(4, "0/4"), begin(5), insert(6, "2")]), 0)
    assert published(p) == [(0, "0/4:1", "1")] and reports[-1] == {"batch": 0, "durable": 4, "open_from": 5, "published": 1, "transactions": 1}
    p(feed(spark, [insert(7, "3")]), 1)
    assert len(published(p)) == 1 and reports[-1]["open_from"] == 5
    p(feed(spark, [], [(8, "{broken")]).limit(1), 2)
    p(feed(spark, [insert(9, "4"), commit(10, "0/A"), begin(11)]), 3)
    assert published(p) == [(0, "0/4:1", "1"), (1, "0/A:1", "2"), (2, "0/A:2", "3"), (3, "0/A:3", "4")]
    assert [tuple(r) for r in p.faults().collect()] == [(8, "unreadable message")]
    with pytest.raises(RuntimeError, match="published before"):
        p(feed(spark, [insert(9, "4")]), 4)
    # The relation is still known after all that described it is gone, and so is the open transaction.
    assert p.vacuum() and p.vacuum() == []
    p(feed(spark, [insert(12, "5"), commit(13, "0/D")]), 4)
    assert published(p)[-1] == (4, "0/D:1", "5") and p.state()["open_from"] is None


def test_a_batch_that_comes_again_writes_the_same(spark, tmp_path):
    p = publish.Publisher(spark, f"{tmp_path}/out")
    write = p.sink
    first, second = [rel(1), begin(2), insert(3, "1")], [insert(4, "2"), commit(5, "0/5"), begin(6), insert(7, "3")]
    p(feed(spark, first), 0)

    def crash(records, batch):
        write(records, batch)
        raise OSError("after the records")

    p.sink = crash
    with pytest.raises(OSError, match="after the records"):
        p(feed(spark, second), 1)
    p.sink = write
    for _ in range(2):
        p(feed(spark, second), 1)
        assert published(p) == [(0, "0/5:1", "1"), (1, "0/5:2", "2")] and p.state()["open_from"] == 6
    # What is sent again from the open transaction's beginning replaces what was kept of it; a reset forgets it.
    p(feed(spark, [begin(6), insert(7, "3")]), 2)
    p.reset()
    p(feed(spark, [begin(6), insert(7, "3"), commit(8, "0/8")]), 3)
    assert published(p)[2:] == [(2, "0/8:1", "3")] and p.faults().isEmpty()


def test_supervised_stream_goes_on_after_a_failure(spark, tmp_path):
    replication.register(spark)
    path, tries, metrics = f"{tmp_path}/feed", [], observe.Metrics()
    replication.write_segments(spark.createDataFrame([rel(1), begin(2), insert(3, "1"), commit(4, "0/4")], decode.MESSAGE), path, per_segment=2)
    p = publish.Publisher(spark, f"{tmp_path}/out", on_commit=metrics.publish_done)
    write = p.sink

    def flaky(records, batch):
        tries.append(batch)
        if len(tries) == 1:
            raise OSError("down")
        write(records, batch)

    p.sink = flaky
    stream = lambda: publish.start(spark.readStream.format("replication").option("path", path).load(), p, f"{tmp_path}/checkpoint", available_now=True)
    topic = lambda brokers: spark.createDataFrame([(brokers, 1, 3, 3, 2)], "brokers int, partitions int, replication int, in_sync int, min_in_sync int")
    with pytest.raises(retry.PermanentError, match="fewer than 3 brokers"):
        publish.supervised(stream, retry.Backoff(base=0.001, attempts=3), checks=[lambda: observe.require_durable(topic(2))])
    with publish.fenced(spark, f"{tmp_path}/out", "s"):
        with pytest.raises(retry.PermanentError, match="at work"), publish.fenced(spark, f"{tmp_path}/out", "s"):
            pass
        publish.supervised(stream, retry.Backoff(base=0.001, attempts=3), p, metrics, [lambda: observe.require_durable(topic(3))])
    assert tries == [0, 0] and published(p) == [(0, "0/4:1", "1")]
    text = observe.answer(metrics, "/metrics")[1]
    assert 'cdc_errors_total{component="stream"} 1' in text and "cdc_messages_published_total 1" in text and "cdc_transactions_acked_total 1" in text


def test_a_feed_that_lost_segments_is_noticed(spark, tmp_path):
    path = f"{tmp_path}/feed"
    replication.write_segments(spark.createDataFrame([rel(10), begin(11)], decode.MESSAGE), path)
    strict = replication.ReplicationReader({"path": path, "failOnDataLoss": "true"})
    assert len(strict.partitions({"lsn": 9}, {"lsn": 11})) == 1
    with pytest.raises(RuntimeError, match="removed before they were read"):
        strict.partitions({"lsn": 5}, {"lsn": 11})
