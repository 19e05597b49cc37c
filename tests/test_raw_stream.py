"""Streams into the raw layer: batches that fail and come again, progress, audit, and loads beside them."""

import datetime as dt

import pytest

from tallyhouse.operators.incremental import EntitySpec
from tallyhouse.plans.bronze_load import BronzeLoader
from tallyhouse.sources.storage import TableStore
from tallyhouse.streaming import raw_stream
from tallyhouse.streaming.file_ingest import file_stream
from tallyhouse.streaming.raw_stream import RawStream
from tests.conftest import rows

SPEC = EntitySpec("items", "date", "id")
D = [dt.date(2024, 1, day) for day in range(1, 10)]


@pytest.fixture
def landing(spark, store: TableStore) -> RawStream:
    source = lambda entity: spark.createDataFrame([(90, D[8]), (1, D[0])], "id int, date date")
    return RawStream(BronzeLoader(spark, store.path("raw"), source, "CARDS", specs={"items": SPEC}), "items", "files")


def batch(spark, *data):
    return spark.createDataFrame(list(data), "id int, date date")


def held(landing):
    return rows(landing.loader.bronze("items").select("id", "date", "pipeline_run_id"))


def test_a_batch_lands_once(spark, landing):
    for _ in range(2):
        landing.land(batch(spark, (1, D[1]), (2, D[3])), 0)
        landing.land(batch(spark, (3, D[2]), (4, None)), 1)
    assert held(landing) == [(1, D[1], "files-0"), (2, D[3], "files-0"), (3, D[2], "files-1"), (4, None, "files-1")]
    assert rows(landing.audit().select("pipeline_run_id", "records_inserted", "status")) == [("files-0", 2, "SUCCESS"), ("files-1", 2, "SUCCESS")]
    # Late rows are loaded, and the checkpoint does not go back.
    reached = landing.loader.state.latest(SPEC)
    assert (reached.watermark, reached.key) == (D[3], 2)


@pytest.mark.parametrize("broken", ["save", "audit_frame"])
def test_a_failed_batch_replaces_what_it_left(spark, landing, monkeypatch, broken):
    """It fails after its rows are written, comes again on a later day, and other rows stay as they are."""
    landing.land(batch(spark, (1, D[1])), 0)

    def fail(*given):
        raise RuntimeError("lost")

    class Later(dt.datetime):
        @classmethod
        def now(cls, tz=None):
            return super().now(tz) + dt.timedelta(days=1)

    with monkeypatch.context() as patch:
        patch.setattr(landing.loader.state if broken == "save" else raw_stream, broken, fail)
        with pytest.raises(RuntimeError, match="lost"):
            landing.land(batch(spark, (2, D[2]), (3, D[2])), 1)
    assert len(held(landing)) == 3
    monkeypatch.setattr(raw_stream, "datetime", Later)
    landing.land(batch(spark, (2, D[2]), (3, D[2])), 1)
    landing.land(batch(spark), 2)
    assert held(landing) == [(1, D[1], "files-0"), (2, D[2], "files-1"), (3, D[2], "files-1")]
    assert sorted(r.records_inserted for r in landing.audit().collect()) == [0, 1, 2]
    assert landing.loader.state.latest(SPEC).key == 3


def test_loads_and_other_schemas_beside_a_stream(spark, landing):
    landing.land(batch(spark, (1, D[1])), 0)
    assert landing.loader.load("items") == 1  # only what is newer than the streamed rows
    landing.land(spark.createDataFrame([(5, D[4], "x")], "id int, date date, note string"), 1)
    found = rows(landing.loader.bronze("items").select("id", "note"))
    assert found == [(1, None), (5, "x"), (90, None)]
    assert landing.loader.state.latest(SPEC).watermark == D[8]


def test_files_that_arrive(spark, landing, store):
    stream = lambda: file_stream(spark, store.path("in"), batch(spark).schema, files_per_batch=1)
    for day in (2, 5, 3):
        batch(spark, (day, D[day])).coalesce(1).write.mode("append").parquet(store.path("in"))
        landing.land_available(stream(), store.path("progress"))
    assert [r[0] for r in held(landing)] == [2, 3, 5] and landing.audit().count() == 3
    assert landing.loader.state.latest(SPEC).watermark == D[5]


def test_names_are_folders(landing):
    assert landing.audit().count() == 0
    with pytest.raises(ValueError, match="becomes a folder"):
        RawStream(landing.loader, "items", "a/b")
