"""Streams fed file by file end in the same state as the batch query."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import responses
from surveyloom.streaming import answers as live
from surveyloom.streaming import versions
from surveyloom.streaming.versions import apply_batch

EVENTS = "session_id bigint, question_id bigint, ts timestamp, event_id bigint, answer string"


def at(hour, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute)


def feed(spark, folder, schema, batches):
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_last_answer(spark, tmp_path, rows):
    stream = feed(spark, tmp_path / "in", EVENTS, [
        [(1, 1, at(10), 1, "a")], [(1, 1, at(10, 5), 3, "b"), (1, 1, at(10, 5), 2, "c"), (2, 1, at(11), 4, "d")], [(2, 1, at(9), 5, "late but kept")]])
    live.write_answer_log(live.last_answers(stream, "1 day"), str(tmp_path / "log"), str(tmp_path / "cp")).awaitTermination()
    current = live.current_answers(spark, str(tmp_path / "log"))
    assert rows(current, "session_id", "question_id", "answer", "event_id") == [(1, 1, "b", 3), (2, 1, "d", 4)]
    assert rows(live.session_answers(current), "*") == [(1, 1, "b"), (2, 1, "d")]


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path, rows):
    stream = feed(spark, tmp_path / "in", EVENTS, [[(1, 1, at(20), 1, "new")], [(9, 9, at(21), 2, "x")], [(1, 2, at(1), 3, "too late")]])
    live.write_answer_log(live.last_answers(stream, "10 minutes"), str(tmp_path / "log"), str(tmp_path / "cp")).awaitTermination()
    assert rows(live.current_answers(spark, str(tmp_path / "log")), "session_id", "answer") == [(1, "new"), (9, "x")]


def test_running_rate_equals_batch(spark, tmp_path, table, rows):
    schema = "user_id bigint, question_id bigint, answer string, effective boolean, question_type string"
    data = [(u, u % 4, "not_answered" if u % 3 == 0 else "y", [True, None, False][u % 3 - 1], [None, "", "own"][u % 5 % 3]) for u in range(60)]
    bank = table("id bigint, seq bigint, question_type string, category string", (0, 0, "x", "c"), (1, 1, "y", "c"), (2, 2, "x", "c"), (1, 3, "later", "c"))
    stream = feed(spark, tmp_path / "in", schema, [data[:20], data[20:35], data[35:]])
    live.write_running_table(live.running_answer_rate(stream, bank), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = responses.answer_rate_by_type(spark.createDataFrame(data, schema), bank)
    assert rows(live.current_rates(spark, str(tmp_path / "out")), "question_type", "total", "answered") == rows(batch, "question_type", "total", "answered")
    assert batch.agg(F.sum("total")).first()[0] > 0


def _answers(spark, *given):
    return spark.createDataFrame([(s, q, at(h), e, a) for s, q, h, e, a in given], live.ANSWERS)


def _apply(batch, number, path):
    apply_batch(batch, number, path, live.ANSWERS, ["session_id", "question_id"], live._last)


def _files(path, suffix=".parquet"):
    return sum(f.name.endswith(suffix) for f in pathlib.Path(path).rglob("*"))


def test_table_size_follows_its_keys(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    for n in range(8):
        _apply(_answers(spark, *[(s, 1, n + 1, 100 * n + s, f"{n}") for s in range(6)]), n, path)
    assert rows(live.current_answers(spark, path), "session_id", "answer") == [(s, "7") for s in range(6)]
    assert len(list((tmp_path / "table" / "data").iterdir())) <= 2 and len(list((tmp_path / "table" / "where").iterdir())) == 2
    _apply(_answers(spark, (0, 1, 1, 5, "older"), (50, 2, 1, 6, "new")), 8, path)  # other buckets stay where they are
    assert rows(live.current_answers(spark, path), "session_id", "answer") == [*((s, "7") for s in range(6)), (50, "new")]
    assert _files(tmp_path / "table" / "data" / "version=8") <= 2
    _apply(_answers(spark, (0, 1, 1, 5, "older"), (50, 2, 1, 6, "new")), 8, path)  # the same batch again
    assert live.current_answers(spark, path).count() == 7
    assert live.current_answers(spark, str(tmp_path / "none")).count() == 0


def test_failed_batch_leaves_the_table_readable(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "table")
    _apply(_answers(spark, (1, 1, 1, 1, "a"), (2, 1, 1, 2, "b")), 0, path)
    real = versions._folder

    def broken(session, folder):
        if "data/version=1" in folder:
            raise OSError("lost")  # after the rows of the batch, before it says where they are
        return real(session, folder)

    monkeypatch.setattr(versions, "_folder", broken)
    with pytest.raises(OSError):
        _apply(_answers(spark, (1, 1, 9, 3, "c")), 1, path)
    assert rows(live.current_answers(spark, path), "session_id", "answer") == [(1, "a"), (2, "b")]
    monkeypatch.undo()
    _apply(_answers(spark, (1, 1, 9, 3, "c")), 1, path)
    assert rows(live.current_answers(spark, path), "session_id", "answer") == [(1, "c"), (2, "b")]
