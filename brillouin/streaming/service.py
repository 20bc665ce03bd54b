"""Requests and results as streams: parsing, soft ordering, staleness, completeness, pairing, rates.

Functions without state take streams and tables alike, so a batch run gives what the stream gives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from io import StringIO

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.tables import parsed_cell

REQUEST = "dcid int, dcgid int, filename string, message_index int, number_of_frames int, start_frame_index int, startTime timestamp, wavelength double, xBeam double, yBeam double, detector_distance double, d_min double, d_max double, unit_cell string, detector string"
#: Detectors: image size and sensor.
DETECTORS = {
    "Eiger16M": {"size": (4148, 4362), "px": 0.075, "thickness": 0.45, "material": "Si"},
    "Eiger9MCdTe": {"size": (3108, 3262), "px": 0.075, "thickness": 0.75, "material": "CdTe"},
    "Eiger4M": {"size": (2068, 2162), "px": 0.075, "thickness": 0.45, "material": "Si"},
}
_NEEDED = ("dcid", "dcgid", "filename", "message_index", "number_of_frames", "start_frame_index", "xBeam", "yBeam", "detector_distance")


def detector_table(spark: SparkSession) -> DataFrame:
    rows = [(k, d["size"][0], d["size"][1], d["px"], d["thickness"], d["material"]) for k, d in DETECTORS.items()]
    return spark.createDataFrame(rows, "detector string, width int, height int, px_mm double, thickness double, material string")


def parsed_requests(messages: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(requests, rejected): JSON messages that fit the model, and the others with their text. Rejected ones are not tried again."""
    rows = messages.withColumn("__r", F.from_json(column, REQUEST, {"mode": "PERMISSIVE"}))
    cell = F.col("__r.unit_cell")
    listed = F.regexp_replace(cell, r"[\[\]]", "")
    ok = F.col("__r").isNotNull()
    for name in _NEEDED:
        ok = ok & F.col(f"__r.{name}").isNotNull()
    ok = ok & (cell.isNull() | parsed_cell(listed).isNotNull())
    ok = F.coalesce(ok, F.lit(False))
    good = rows.where(ok).select("__r.*").withColumns({"unit_cell": parsed_cell(F.regexp_replace("unit_cell", r"[\[\]]", "")), "detector": F.coalesce("detector", F.lit("Eiger16M"))})
    return good, rows.where(~ok).drop("__r")


def fresh(requests: DataFrame, now=None, max_age: str = "60 seconds", has_data: str | None = None) -> DataFrame:
    """Requests that are not old, or whose data are there (a boolean column); without a start time they are not old."""
    now = F.current_timestamp() if now is None else now
    young = F.col("startTime").isNull() | (F.col("startTime") + F.expr(f"INTERVAL {max_age}") >= now)
    return requests.where(young | F.col(has_data) if has_data else young)


def message_gaps(messages: DataFrame, key: str, index: str, order: list[str]) -> DataFrame:
    """Messages of a group whose index is not one more than that of the message before, in `order` of arrival: adds expected."""
    w = Window.partitionBy(key).orderBy(*order)
    rows = messages.withColumn("expected", F.coalesce(F.lag(index).over(w) + 1, F.lit(0)))
    return rows.where(F.col(index) != F.col("expected"))


def in_order(requests: DataFrame, wait_ms: int = 5000, keep_ms: int = 3_600_000) -> DataFrame:
    """Requests of each dcgid in message order: one that comes early waits up to `wait_ms` for those before it, then goes anyway.

    A stream only. State is the next index and each row that waits, as a text of its own that is read when it goes; rows that come late go at once. The state of a
    dcgid from which nothing has come for `keep_ms` is removed, so state does not grow with the collections ever seen; a message after that is counted from 0 again.
    """
    schema = requests.schema
    names = schema.names

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        wanted, places, texts = state.get if state.exists else (0, [], [])
        held = sorted(zip(places, texts, strict=True), key=lambda x: x[0])
        if state.hasTimedOut:
            if not held:
                state.remove()
                return
            ready, held = held, []
            wanted = max(wanted, ready[-1][0] + 1)
        else:
            for rows in batches:
                lines = rows[names].to_json(orient="records", lines=True, date_format="iso", date_unit="us").splitlines()
                held += zip(map(int, rows["message_index"]), lines, strict=True)
            held.sort(key=lambda x: x[0])
            n = 0
            while n < len(held) and held[n][0] <= wanted:
                wanted += held[n][0] == wanted
                n += 1
            ready, held = held[:n], held[n:]
        state.update((int(wanted), [p for p, _ in held], [t for _, t in held]))
        state.setTimeoutDuration(wait_ms if held else keep_ms)
        if ready:
            yield _typed(pd.read_json(StringIO("\n".join(t for _, t in ready)), dtype=False, lines=True)[names], schema)

    return requests.groupBy("dcgid").applyInPandasWithState(step, schema, "wanted int, places array<int>, texts array<string>", "append", GroupStateTimeout.ProcessingTimeTimeout)


def _typed(rows: pd.DataFrame, schema) -> pd.DataFrame:
    out = rows.copy()
    for field in schema:
        kind = field.dataType.simpleString()
        if kind == "timestamp":
            out[field.name] = pd.to_datetime(out[field.name]).dt.tz_localize(None)
        elif kind in ("int", "bigint"):
            out[field.name] = out[field.name].astype("Int64")
        elif kind == "double":
            out[field.name] = out[field.name].astype(float)
    return out


def completeness(frames: DataFrame, idle_ms: int = 30000) -> DataFrame:
    """(dataset, seen, expected, status): complete once all expected frames are seen, incomplete after an idle time. A stream only.

    `frames`: dataset, frame, n_images. Frames that come twice count once. A complete dataset is remembered for `idle_ms` more: frames that it had change nothing,
    new ones reopen it, and it is complete again as soon as the frames it then expects are there.
    """
    kind = frames.schema["dataset"].dataType.simpleString()

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, expected, told = state.get if state.exists else ([], 0, 0)
        if state.hasTimedOut:
            state.remove()
            if told < len(seen):
                yield pd.DataFrame({"dataset": [key[0]], "seen": [len(seen)], "expected": [expected], "status": ["incomplete"]})
            return
        had = set(seen)
        for rows in batches:
            had.update(int(x) for x in rows["frame"])
            expected = max(expected, int(rows["n_images"].max()))
        if expected <= len(had) != told:
            told = len(had)
            yield pd.DataFrame({"dataset": [key[0]], "seen": [len(had)], "expected": [expected], "status": ["complete"]})
        state.update((sorted(had), expected, told))
        state.setTimeoutDuration(idle_ms)

    return frames.groupBy("dataset").applyInPandasWithState(step, f"dataset {kind}, seen long, expected long, status string", "seen array<int>, expected int, told int", "append", GroupStateTimeout.ProcessingTimeTimeout)


def paired(results: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Both arms' results of a dcid side by side: (dcid, ts_gpu, results_gpu, ts_cpu, results_cpu). `results`: dcid, gpu, ts, results.

    The first result of each arm counts; take repeats from `repeated`.
    """
    stream = results.isStreaming
    marked = results.withWatermark("ts", delay) if stream else results
    if stream:
        once = marked.dropDuplicatesWithinWatermark(["dcid", "gpu"])
    else:
        w = Window.partitionBy("dcid", "gpu").orderBy("ts")
        once = marked.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    a = once.where("gpu").select(F.col("dcid"), F.col("ts").alias("ts_gpu"), F.col("results").alias("results_gpu"))
    b = once.where("NOT gpu").select(F.col("dcid").alias("__dcid"), F.col("ts").alias("ts_cpu"), F.col("results").alias("results_cpu"))
    near = F.col("dcid") == F.col("__dcid")
    if stream:
        near = near & (F.col("ts_cpu") >= F.col("ts_gpu") - F.expr(f"INTERVAL {delay}")) & (F.col("ts_cpu") <= F.col("ts_gpu") + F.expr(f"INTERVAL {delay}"))
    return a.join(b, near).drop("__dcid")


def repeated(results: DataFrame) -> DataFrame:
    """Results of an arm that already had one for the dcid (a table, or a foreachBatch part): the error sink's rows."""
    w = Window.partitionBy("dcid", "gpu").orderBy("ts")
    return results.withColumn("__n", F.row_number().over(w)).where("__n > 1").drop("__n")


def published(results: DataFrame) -> DataFrame:
    """Per-frame results with their arrival time; frames are counted from 1."""
    return results.withColumns({"frame": F.col("frame") + 1, "arrived": F.current_timestamp()})


def rates(events: DataFrame, time: str, key: list[str], value: str, width: str = "1 hour", delay: str | None = None) -> DataFrame:
    """Rows and the sum of a value in tumbling windows of time."""
    rows = events.withWatermark(time, delay) if delay and events.isStreaming else events
    out = rows.groupBy(F.window(time, width).alias("w"), *key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("start"), *key, "n", "total")


def finalised(rows: DataFrame, batch: int, finalise: Callable[[SparkSession, list, int], None], ledger: str) -> list:
    """Finalises the complete datasets of a micro-batch that the ledger does not hold for it yet, and enters them; returns their names.

    A batch that comes again after a failure finds its entries and does nothing. Where the failure came between the work and the entry, `finalise` is called
    again with the same batch number: it writes under that number, in place of what it wrote before, so the effect is that of one call.
    """
    spark = rows.sparkSession
    entries = f"{ledger.rstrip('/')}/batch={batch}"
    names = sorted({r[0] for r in rows.where("status = 'complete'").select("dataset").collect()}, key=str)  # a few at a time
    try:
        known = {r[0] for r in spark.read.schema(f"dataset {rows.schema['dataset'].dataType.simpleString()}").parquet(entries).collect()}
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        known = set()
    due = [n for n in names if n not in known]
    if due:
        finalise(spark, due, batch)
        spark.createDataFrame([(n,) for n in names], rows.select("dataset").schema).coalesce(1).write.mode("overwrite").parquet(entries)
    return due


def on_complete(status: DataFrame, finalise: Callable[[SparkSession, list, int], None], checkpoint: str, ledger: str) -> StreamingQuery:
    """Calls `finalise` with the datasets that have become complete and the number of the batch, each once (see `finalised`); the caller then runs the batch job for them.

    Datasets arrive a few at a time; their names are all that reaches the driver. `checkpoint` and `ledger` are folders that outlive the query.
    """
    return status.writeStream.outputMode("append").foreachBatch(lambda rows, batch: finalised(rows, batch, finalise, ledger) and None).option("checkpointLocation", checkpoint).start()


def per_batch(rows: DataFrame, work: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Applies a batch operator (indexing of each frame's spots, say) to each micro-batch and appends its rows at `path`."""
    return rows.writeStream.foreachBatch(lambda part, _: work(part).write.mode("append").parquet(path)).option("checkpointLocation", checkpoint).start()


def run_summary(frames: DataFrame) -> DataFrame:
    """Images, seconds, images a second and GB a second of each dataset: dataset, ts, bytes."""
    seconds = F.max("ts").cast("double") - F.min("ts").cast("double")
    rows = frames.groupBy("dataset").agg(F.count(F.lit(1)).alias("images"), seconds.alias("seconds"), F.sum("bytes").alias("bytes"))
    rate = lambda c: F.when(F.col("seconds") > 0, c / F.col("seconds"))
    return rows.withColumns({"fps": rate(F.col("images")), "gb_per_s": rate(F.col("bytes") / 1e9)}).drop("bytes")
