"""Streaming forms against their batch results, with files arriving in steps."""

import datetime as dt

from pyspark.sql import functions as F

from leadlens.streaming import stream_dedup, stream_hourly_cells
from leadlens.streaming.events import read_event_stream, run_available

from conftest import values

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id int, ts timestamp_ntz, kind string"


def write(frame, path, name, rows):
    frame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


def test_dedup_across_files(spark, frame, tmp_path):
    rows = [(i, T0 + dt.timedelta(minutes=i), "a") for i in range(20)]
    write(frame, tmp_path / "in", "1", rows)
    write(frame, tmp_path / "in", "2", rows[10:])
    stream = read_event_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    out = run_available(stream_dedup(stream, ["id"], "ts", "1 hour"), "d")
    assert values(out, "id") == sorted([(i,) for i in range(20)], key=repr)


def test_hourly_cells_drop_late_rows(spark, frame, tmp_path):
    write(frame, tmp_path / "in", "1", [(1, T0, "a"), (2, T0 + dt.timedelta(minutes=5), "a")])
    stream = read_event_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    out = run_available(stream_hourly_cells(stream, "ts", ["kind"], "10 minutes"), "c", "update")
    newest = out.groupBy("d", "hr", "kind").agg(F.max(F.struct("batch", "n"))["n"].alias("n"))
    assert values(newest, "hr", "kind", "n") == [(0, "a", 2)]


def test_single_file_source(spark):
    stream = read_event_stream(spark, "/root/testdata/sf0.001/events.parquet")
    out = run_available(stream.select("event_id"), "plain")
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()


def test_paths_are_taken_as_they_are(spark, frame, tmp_path):
    for name in ("plain", "a[b]c", "x{1,2}", "star*", "what?", "back\\slash", "z]"):
        folder = tmp_path / name
        folder.mkdir()
        (tmp_path / "decoy").mkdir(exist_ok=True)
        source = tmp_path / "decoy" / "in"
        if not source.exists():
            write(frame, source, "1", [(1, T0, "a"), (2, T0, "b")])
        for part in source.glob("*.parquet"):
            (folder / part.name).write_bytes(part.read_bytes())
        for path in (str(folder), f"{folder}/"):
            out = run_available(read_event_stream(spark, path).select("id"), "paths")
            assert values(out, "id") == [(1,), (2,)], name
        (single,) = folder.glob("*.parquet")
        assert run_available(read_event_stream(spark, str(single)).select("id"), "file").count() == 2


def test_no_input_gives_no_rows(spark, tmp_path):
    empty = tmp_path / "empty"
    empty.mkdir()
    stream = read_event_stream(spark, str(empty), schema=SCHEMA)
    assert run_available(stream_dedup(stream, ["id"], "ts", "1 hour"), "none").columns == ["id", "ts", "kind"]
    cells = run_available(stream_hourly_cells(stream, "ts", ["kind"], "1 hour"), "none", "update")
    assert cells.columns == ["d", "hr", "kind", "n", "batch"] and cells.count() == 0
