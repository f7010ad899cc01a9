"""The alert sink: whole batches, once, whatever fails."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import alerts
from tidemark.params import AlertParams
from tidemark.sources import alert_sink


@pytest.fixture
def raised(spark):
    rows = [("WARNING", "drift", f"title {i}", "line\nbreak é", '{"k": "v"}', None) for i in range(20)]
    rows.append(("INFO", "drift", "not serious", "m", None, None))
    return spark.createDataFrame(rows, schemas.ALERT).repartition(4)


def delivered(folder, batch):
    files = sorted((folder / batch).glob("*.jsonl"))
    return sorted(json.loads(line)["title"] for f in files for line in f.read_text().splitlines())


def test_a_batch_is_delivered_once(spark, raised, tmp_path):
    expected = sorted(f"title {i}" for i in range(20))
    for _ in range(2):  # the second time the batch is there already
        alerts.deliver(raised, [alert_sink.sink(str(tmp_path), "run-1")], AlertParams("WARNING"))
        assert delivered(tmp_path, "run-1") == expected
    alert_sink.deliver_to(raised.limit(0), str(tmp_path), "run-2")
    assert delivered(tmp_path, "run-2") == []
    assert list((tmp_path / "_staged").iterdir()) == []
    with pytest.raises(Exception, match="not a name for a batch"):
        alert_sink.deliver_to(raised, str(tmp_path), "a/b")


def test_a_failing_task_leaves_nothing_to_see(spark, raised, tmp_path):
    bad = raised.withColumn(
        "title", F.when(F.col("title") == "title 7", F.raise_error(F.lit("lost"))).otherwise(F.col("title"))
    )
    with pytest.raises(Exception, match="lost"):
        alert_sink.deliver_to(bad, str(tmp_path), "run-1")
    assert not (tmp_path / "run-1").exists() and list((tmp_path / "_staged").iterdir()) == []
    alert_sink.deliver_to(raised, str(tmp_path), "run-1")
    assert len(delivered(tmp_path, "run-1")) == 21


def test_a_repeated_attempt_counts_once(tmp_path):
    writer = alert_sink.AlertWriter(f"file://{tmp_path}", "b")
    rows = [Row(payload=json.dumps({"title": str(i)})) for i in range(3)]

    def lost():
        yield rows[0]
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        writer.write(lost())
    writer.write(iter(rows))  # ended, but its message never arrived
    message = writer.write(iter(rows))
    writer.commit([message, None])
    assert delivered(tmp_path, "b") == ["0", "1", "2"] and list((tmp_path / "_staged").iterdir()) == []
