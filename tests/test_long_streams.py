"""Streams over several micro-batches: waiting, timing out, eviction, reopening, and batches that come again."""

import json
import time

from brillouin.streaming import service


def put(folder, name, rows):
    (folder / f".{name}").write_text("\n".join(map(json.dumps, rows)))
    (folder / f".{name}").rename(folder / f"{name}.json")


def waited(query, test, seconds=60):
    end = time.time() + seconds
    while not test():
        assert time.time() < end and query.exception() is None
        time.sleep(0.3)


def taken(query, rows):
    """Waits until so many rows have gone through whole micro-batches."""
    waited(query, lambda: sum(p["numInputRows"] for p in query.recentProgress) >= rows)


def held(query):
    return query.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_messages_wait_time_out_and_are_forgotten(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    stream = spark.readStream.schema("dcgid int, message_index int, note string, at timestamp").option("maxFilesPerTrigger", 1).json(str(folder))
    query = service.in_order(stream, wait_ms=25000, keep_ms=4000).writeStream.format("memory").queryName("ordered_long").option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").start()
    got = lambda g: [(r["message_index"], r["note"]) for r in spark.table("ordered_long").collect() if r["dcgid"] == g]
    try:
        row = lambda g, k: {"dcgid": g, "message_index": k, "note": f"n{k}", "at": "2026-01-01T00:00:00.123456"}
        put(folder, "a", [row(1, 3), row(1, 2)])
        taken(query, 2)
        assert got(1) == []
        put(folder, "b", [row(1, 0), row(2, 5)])
        taken(query, 4)
        assert got(1) == [(0, "n0")] and got(2) == []
        put(folder, "c", [row(1, 1)])
        taken(query, 5)
        assert got(1) == [(k, f"n{k}") for k in range(4)]
        put(folder, "d", [row(1, 2)])  # late: at once
        taken(query, 6)
        assert got(1)[4:] == [(2, "n2")]
        waited(query, lambda: got(2) == [(5, "n5")])  # its time is over
        waited(query, lambda: held(query) == 0)  # nothing came for long: no state is left
        assert spark.table("ordered_long").where("at <> TIMESTAMP'2026-01-01 00:00:00.123456'").count() == 0
    finally:
        query.stop()


def test_datasets_reopen_time_out_and_are_forgotten(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    frames = spark.readStream.schema("dataset string, frame int, n_images int").option("maxFilesPerTrigger", 1).json(str(folder))
    query = service.completeness(frames, 25000).writeStream.format("memory").queryName("complete_long").option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").start()
    got = lambda: [(r["dataset"], r["seen"], r["expected"], r["status"]) for r in spark.table("complete_long").collect()]
    try:
        row = lambda d, k, n: {"dataset": d, "frame": k, "n_images": n}
        put(folder, "a", [row("x", 0, 2), row("y", 0, 3)])
        put(folder, "b", [row("x", 1, 2)])
        put(folder, "c", [row("x", 1, 2)])  # once more: changes nothing
        taken(query, 4)
        assert got() == [("x", 2, 2, "complete")]
        put(folder, "d", [row("x", 2, 3)])  # late: it has one more than was said
        taken(query, 5)
        assert got() == [("x", 2, 2, "complete"), ("x", 3, 3, "complete")]
        waited(query, lambda: ("y", 1, 3, "incomplete") in got() and held(query) == 0)
        assert len(got()) == 3
    finally:
        query.stop()


def test_a_batch_that_comes_again_finalises_once(spark, tmp_path):
    calls, rows = [], spark.createDataFrame([("x", "complete"), ("y", "incomplete"), ("z", "complete"), ("x", "complete")], "dataset string, status string")
    work = lambda _, names, batch: calls.append((batch, names))
    ledger = str(tmp_path / "ledger")

    def failing(_, names, batch):
        calls.append((batch, names))
        raise OSError("lost")

    try:
        service.finalised(rows, 4, failing, ledger)
    except OSError:
        pass
    assert service.finalised(rows, 4, work, ledger) == ["x", "z"]  # not entered: called again under the same number
    assert service.finalised(rows, 4, work, ledger) == []
    assert service.finalised(rows, 5, work, ledger) == ["x", "z"]  # reopened and complete again in a later batch
    assert calls == [(4, ["x", "z"]), (4, ["x", "z"]), (5, ["x", "z"])]


def test_finalisation_of_a_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, "a", [{"dataset": "x", "frame": k, "n_images": 2} for k in (0, 1)])
    calls = []
    frames = spark.readStream.schema("dataset string, frame int, n_images int").json(str(folder))
    query = service.on_complete(service.completeness(frames, 600_000), lambda _, names, batch: calls.append(names), str(tmp_path / "ck"), str(tmp_path / "ledger"))
    try:
        waited(query, lambda: calls)
    finally:
        query.stop()
    assert calls == [["x"]]
