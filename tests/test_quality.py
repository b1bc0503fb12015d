"""Observed quality of log streams, and the records set aside."""

from conftest import rows
from pyspark.sql import Observation

from rankstream import schemas
from rankstream.sources import records
from rankstream.sources.streams import file_stream
from rankstream.streaming import quality
from rankstream.streaming.logs import bronze_logs
from rankstream.streaming.metrics import server_metrics

HEADER = bytes(records.HEADER_BYTES)
WHOLE = b'{"puuid":"p","timestamp":"2024-01-01T10:00:00+00:00","request_type":"GET","endpoint_path":"/x",' \
    b'"status_code":200,"response_size":1,"response_time":2}'
VALUES = [HEADER + WHOLE, HEADER + b'{"puuid":"q"}', HEADER + b"{broken", None, b"", HEADER + WHOLE]


def wire(spark, values):
    return spark.createDataFrame([(v,) for v in values], schemas.WIRE_RECORD)


def test_flags_agree_with_decode(spark):
    flagged = records.decode_flagged(wire(spark, VALUES))
    plain = rows(records.decode(wire(spark, VALUES)).filter("puuid IS NOT NULL"))
    assert rows(flagged.filter("NOT unread").drop("value", "unread", "defaulted")) == plain
    assert rows(flagged, "unread", "defaulted") == [
        (False, 0), (False, 0), (False, 6), (True, 7), (True, 7), (True, 7)]


def test_observation_in_a_batch(spark):
    seen = Observation("log_quality")
    quality.decode_observed(wire(spark, VALUES), seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"arrived": 6, "undecodable": 3, "defaulted": 1}


def test_batches_are_counted_and_set_aside(spark, store, table_name, tmp_path):
    names = [f"{table_name}_{n}" for n in ("good", "bad", "counts")]
    for part in (VALUES[:3], VALUES[3:]):
        wire(spark, part).write.mode("append").parquet(str(tmp_path / "in"))
        arrived = file_stream(spark, str(tmp_path / "in"), schemas.WIRE_RECORD)
        quality.drain_checked(arrived, store, *names, str(tmp_path / "check"))
    assert rows(store.read(names[2]), *schemas_of_counts()) == [(0, 3, 1, 1), (1, 3, 2, 0)]
    assert rows(store.read(names[0]), "puuid", "batch_id") == [("p", 0), ("p", 1), ("q", 0)]
    set_aside = {(r.value and bytes(r.value), r.batch_id) for r in store.read(names[1]).collect()}
    assert set_aside == {(VALUES[2], 0), (None, 1), (b"", 1)}


def schemas_of_counts():
    return quality.COUNTS.fieldNames()


def test_late_rows_are_counted(spark, tmp_path):
    """The progress of a query has the observed counts and the rows behind the watermark."""
    progress = []
    for hours in ((10, 15), (16,), (9, 17)):
        made = [HEADER + WHOLE.replace(b"T10:", f"T{h:02d}:".encode()) for h in hours]
        wire(spark, made).write.mode("append").parquet(str(tmp_path / "in"))
        arrived = file_stream(spark, str(tmp_path / "in"), schemas.WIRE_RECORD)
        logs = bronze_logs(quality.decode_observed(arrived))
        query = (
            server_metrics(logs, delay="10 minutes").writeStream.outputMode("append").format("parquet")
            .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True)
            .start(str(tmp_path / "out"))
        )
        query.awaitTermination()
        progress += [p for p in query.recentProgress if p["numInputRows"]]
    found = quality.progress_counts(spark, progress)
    assert rows(found, "arrived", "undecodable", "late") == [(1, 0, 0), (2, 0, 0), (2, 0, 1)]
