"""Requests from a queue: acknowledged once, in order, none lost and none twice."""

import json

import pytest
from pyspark.sql import functions as F

from brillouin.streaming import service
from brillouin.streaming.subscription import Requests, Spool, accepted

GOOD = {"dcid": 1, "dcgid": 1, "filename": "f", "message_index": 0, "number_of_frames": 2, "start_frame_index": 0, "xBeam": 1.0, "yBeam": 2.0, "detector_distance": 3.0}


def put(folder, *numbers, text=None):
    for n in numbers:
        (folder / f"{n}.tmp").write_text(text or json.dumps({**GOOD, "dcid": n}))
        (folder / f"{n}.tmp").rename(folder / f"{n}.json")


def test_spool(tmp_path):
    queue = Spool({"path": str(tmp_path)})
    assert queue.last() == queue.acknowledged() == -1
    put(tmp_path, 0, 1, 3)
    (tmp_path / "other.json").write_text("no message")
    assert queue.last() == 1 and [n for n, _ in queue.fetch(0, 1)] == [0, 1]
    queue.acknowledge(1)
    queue.acknowledge(0)  # comes late
    assert (queue.acknowledged(), queue.last()) == (1, 1)
    put(tmp_path, 2)
    assert queue.last() == 3 and sorted(p.name for p in tmp_path.glob("*.json")) == ["2.json", "3.json", "other.json"]


def test_a_restart_repeats_and_loses_no_request(spark, tmp_path, monkeypatch):
    folder = tmp_path / "queue"
    folder.mkdir()
    spark.dataSource.register(Requests)
    queue = Spool({"path": str(folder)})

    def run():
        stream = spark.readStream.format("requests").option("broker", "brillouin.streaming.subscription:Spool").option("path", str(folder)).option("messagesPerTask", 2).load()
        query = accepted(stream, requests=str(tmp_path / "good"), rejected=str(tmp_path / "bad"), checkpoint=str(tmp_path / "ck"), available_now=True)
        query.awaitTermination(120)
        assert not query.isActive

    def held():
        good = spark.read.parquet(str(tmp_path / "good"))
        bad = spark.read.parquet(str(tmp_path / "bad"))
        return sorted(r["dcid"] for r in good.collect()), sorted(r["number"] for r in bad.collect())

    put(folder, 0, 1, 3, 4)
    put(folder, 2, text="no json")
    put(folder, 6)  # 5 is late
    run()
    assert held() == ([0, 1, 3, 4], [2]) and queue.last() == 4
    # the next batch writes its requests, then fails before it is finished
    put(folder, 5)
    whole = service.parsed_requests
    monkeypatch.setattr("brillouin.streaming.subscription.parsed_requests", lambda rows: (whole(rows)[0], rows.select(F.raise_error(F.lit("lost")).alias("number"))))
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.undo()
    assert queue.acknowledged() == 4 and [p.name for p in sorted(folder.glob("*.json"))] == ["5.json", "6.json"]
    run()
    assert held() == ([0, 1, 3, 4, 5, 6], [2])
    put(folder, 7, 8)
    run()
    assert held() == ([0, 1, 3, 4, 5, 6, 7, 8], [2]) and queue.acknowledged() >= 6
