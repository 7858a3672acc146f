"""Rows that several steps need are built once, and text that is read back is compressed."""

import os

import pytest

from shelfsense.operators import drift
from shelfsense.plans import catalog, serving

SF = "/root/testdata/sf0.001"


class Seen(Exception):
    pass


def names(folder):
    return [n for n in os.listdir(folder.removeprefix("file:")) if n.startswith("part-")]


def test_drift_halves_come_from_written_rows(spark, monkeypatch):
    def look(df, *rest):
        raise Seen(df.inputFiles())

    monkeypatch.setattr(drift, "half_split", look)
    df = spark.createDataFrame([("a", 1.0, "x", 0)], "dt string, n double, c string, unused int")
    with pytest.raises(Seen) as seen:
        drift.all_statistics(df, ["n"], ["c"], "dt")
    assert all("drift-rows" in f for f in seen.value.args[0]) and seen.value.args[0]


def test_baseline_comparison_reads_written_rows(spark):
    files = catalog.baseline_comparison(spark, SF).inputFiles()
    assert files and all("stage1-rows" in f for f in files)


def test_prediction_log_lines_are_compressed(spark):
    files = catalog.prediction_log_json(spark, SF).inputFiles()
    assert files and all(f.endswith(".gz") for f in files)


def test_request_files_are_compressed(spark, monkeypatch):
    def look(spark, src, *rest, **kw):
        raise Seen(src, kw)

    monkeypatch.setattr(catalog.stream, "score_stream", look)
    with pytest.raises(Seen) as seen:
        catalog.stream_scoring(spark, SF)
    assert names(seen.value.args[0]) and all(n.endswith(".json.gz") for n in names(seen.value.args[0]))


def test_two_batches_have_as_many_files_as_their_rows_need(spark, monkeypatch):
    def look(spark, src, *rest, **kw):
        raise Seen(src, kw)

    monkeypatch.setattr(serving, "_fitted", lambda *a: None)
    monkeypatch.setattr(serving, "_saved", lambda *a: ("nowhere", None))
    monkeypatch.setattr(serving.stream, "score_model_stream", look)
    rows = catalog._requests(spark, SF).count()
    monkeypatch.setattr(serving.stream, "FILE_ROWS", -(-rows // 6))
    with pytest.raises(Seen) as seen:
        serving.stream_model_scoring(spark, SF)
    src, kw = seen.value.args
    assert len(names(src)) == 6 and kw["max_files_per_trigger"] == 3 and all(n.endswith(".gz") for n in names(src))


def test_streamed_requests_are_built_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    plain = catalog._requests(spark, SF)
    rows = plain.count()
    monkeypatch.setattr(catalog, "_requests", lambda *a: plain.mapInArrow(look, plain.schema))
    got = serving.stream_model_scoring(spark, SF).first()
    assert got.n_rows > 1000 and got.batches == 2 and got.changed == 0
    assert seen.value == rows


def test_a_million_requests_of_a_batch_are_read_by_several_tasks():
    assert -(-1_000_000 // serving.stream.FILE_ROWS) >= 4
