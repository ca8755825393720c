import datetime as dt

import pytest

from loanloom.sources import decision_log, sinks
from loanloom.streaming import decisions as streamed

SCHEMA = (
    "application_id int, request_date date, uw_decision string, info string, organization string, refusal_score double, "
    "refusal_percentile int, default_score double, default_percentile int"
)
ATTRIBUTES = ["application_id", "request_date"]


def decided(spark, *ids):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame([(i, day, "accept" if i % 2 else "n/a", None, "o", 0.1 * i, 5, 0.2, 10) for i in ids], SCHEMA)


def ids(spark, base, at=None):
    """Refusal scores, times ten, in the log, and the number of attributes."""
    tables = decision_log.read_all(spark, base, ["logs", "attributes"], at)
    return sorted(round(r.refusal_score * 10) for r in tables["logs"].collect()), tables["attributes"].count()


def crash_at(monkeypatch, number):
    """Fail before the write of this number."""
    write, calls = sinks.write_table, []

    def failing(*args, **kw):
        calls.append(args)
        if len(calls) == number:
            raise OSError("executor lost")
        write(*args, **kw)

    monkeypatch.setattr(sinks, "write_table", failing)


@pytest.mark.parametrize("number", [1, 2, 3])
def test_a_crash_shows_nothing_of_the_batch(spark, tmp_path, monkeypatch, number):
    """Before the logs, between logs and attributes, and before the commit."""
    base = str(tmp_path)
    decision_log.write_decisions(decided(spark, 1, 2), base, ATTRIBUTES, batch_id=0)
    with monkeypatch.context() as patched, pytest.raises(OSError):
        crash_at(patched, number)
        decision_log.write_decisions(decided(spark, 3, 4, 5), base, ATTRIBUTES, batch_id=1)
    assert ids(spark, base) == ([1, 2], 1)
    decision_log.write_decisions(decided(spark, 3, 4, 5), base, ATTRIBUTES, batch_id=1)
    assert ids(spark, base) == ([1, 2, 3, 4, 5], 3)


def test_a_crashed_repeat_leaves_the_batch_as_it_was(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    decision_log.write_decisions(decided(spark, 1), base, ATTRIBUTES, batch_id=0)
    with monkeypatch.context() as patched, pytest.raises(OSError):
        crash_at(patched, 2)
        decision_log.write_decisions(decided(spark, 7), base, ATTRIBUTES, batch_id=0)
    assert ids(spark, base) == ([1], 1)


def test_repeats_replace_and_versions_stay(spark, tmp_path):
    base = str(tmp_path)
    write = lambda batch, *numbers: decision_log.write_decisions(decided(spark, *numbers), base, ATTRIBUTES, batch_id=batch)
    assert [write("a/b=1", 1, 3), write(5, 5), write("a/b=1", 9)] == [1, 2, 3]
    assert ids(spark, base) == ([5, 9], 2)
    assert ids(spark, base, at=2) == ([1, 3, 5], 3)
    assert sorted(r.batch_id for r in decision_log.read(spark, base, "logs").collect()) == ["5", "a/b=1"]


def test_empty_batches_missing_tables_and_unknown_logs(spark, tmp_path):
    base = str(tmp_path)
    assert decision_log.version(spark, base) == 0 and decision_log.commits(spark, base).count() == 0
    with pytest.raises(LookupError):
        decision_log.read(spark, base, "logs")
    decision_log.write_decisions(decided(spark), base, ATTRIBUTES)
    assert ids(spark, base) == ([], 0) and decision_log.damaged(spark, base).count() == 0
    decision_log.append(spark, base, {"logs": spark.createDataFrame([(1, 2)], "id int, more int")}, 0)
    assert decision_log.read(spark, base, "logs").columns == ["id", "more", "batch_id"]
    with pytest.raises(LookupError):
        decision_log.read(spark, base, "attributes")
    with pytest.raises(ValueError):
        decision_log.append(spark, base, {"logs": spark.createDataFrame([(1,)], "Attempt int")}, 0)


def test_lost_files_are_found(spark, tmp_path):
    base = str(tmp_path)
    decision_log.write_decisions(decided(spark, 1, 2, 3), base, ATTRIBUTES, batch_id=0)
    assert decision_log.damaged(spark, base).collect() == []
    for file in tmp_path.glob("attributes/batch_id=0/*/*.parquet"):
        file.unlink()
    assert [tuple(r) for r in decision_log.damaged(spark, base).collect()] == [("0", "attributes", 2, 0)]


def test_a_stream_that_fails_is_taken_up_again(spark, tmp_path, monkeypatch):
    """The batch that failed is repeated after the restart; every application is in the log once."""
    src, base, checkpoint = (str(tmp_path / d) for d in ("src", "log", "chk"))
    for part in ((1, 2), (3, 4)):
        decided(spark, *part).coalesce(1).write.mode("append").parquet(src)
    stream = lambda: streamed.stream_decisions(
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src), lambda b: b, base, checkpoint, ATTRIBUTES,
        organization="o", write_batch=decision_log.write_decisions,
    )
    with monkeypatch.context() as patched, pytest.raises(Exception, match="executor lost"):
        crash_at(patched, 5)
        stream().awaitTermination()
    assert len(ids(spark, base)[0]) == 2
    stream().awaitTermination()
    assert ids(spark, base) == ([1, 2, 3, 4], 2)
