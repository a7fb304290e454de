"""Streaming assignment equals the batch assignment of the same rows."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from townpull.operators import metro_rules as MR
from townpull.operators.filters import filter_populated_places, split_metros
from townpull.operators.radius_join import build_cell_index
from townpull.plans.assign import assign_metros, with_radius
from townpull.sources.files import write_dump
from townpull.sources.fixture import places
from townpull.streaming.assign_stream import read_dump_stream, start_assignment_file_stream, start_assignment_stream


def test_stream_matches_batch(spark, tmp_out):
    pl = places(spark, SF_SMALL)
    metros, towns = split_metros(MR.flag_metros(filter_populated_places(pl), "share_only"))
    index = build_cell_index(with_radius(metros))
    src = os.path.join(tmp_out, "incoming")
    write_dump(towns.repartition(3), src)
    q = start_assignment_stream(read_dump_stream(spark, src), index, os.path.join(tmp_out, "sink"),
                                os.path.join(tmp_out, "chk"))
    q.awaitTermination(180)
    got = {r["geonameid"]: r["assigned_metro_id"] for r in spark.read.parquet(os.path.join(tmp_out, "sink")).collect()}
    want = {r["geonameid"]: r["assigned_metro_id"] for r in
            assign_metros(pl, rule="share_only").filter(~F.col("isMetro")).collect()}
    assert got == want


@pytest.mark.parametrize("start", [start_assignment_stream, start_assignment_file_stream])
def test_a_stopped_stream_goes_on_where_it_was(spark, tmp_out, monkeypatch, start):
    """A task fails in the second of three batches; the next start, by a newer index, loses and doubles no row."""
    import townpull.operators.arrow_eval as AE
    pl = places(spark, SF_SMALL)
    metros, towns = split_metros(MR.flag_metros(filter_populated_places(pl), "share_only"))
    index = build_cell_index(with_radius(metros))
    src, sink, chk = (os.path.join(tmp_out, x) for x in ("incoming", "sink", "chk"))
    # one bad file: a town whose evaluation raises
    parts = towns.randomSplit([1.0, 1.0, 1.0], 3)
    for i, part in enumerate(parts):
        write_dump(part.coalesce(1), os.path.join(tmp_out, f"part{i}"))
    os.makedirs(src)

    def deliver(i):
        for f in os.listdir(os.path.join(tmp_out, f"part{i}")):
            if f.startswith("part-"):
                os.link(os.path.join(tmp_out, f"part{i}", f), os.path.join(src, f"{i}-{f}"))

    deliver(0)
    start(read_dump_stream(spark, src), index, sink, chk, version="one").awaitTermination(180)
    deliver(1)
    deliver(2)
    whole = AE.evaluate_batches

    def broken(*a, **k):
        fn = whole(*a, **k)

        def run(batches):
            for b in fn(batches):
                raise RuntimeError("lost")
            yield from ()
        return run

    monkeypatch.setattr(AE, "evaluate_batches", broken)
    with pytest.raises(Exception, match="lost"):
        start(read_dump_stream(spark, src, 1), index, sink, chk, version="two").awaitTermination(180)
    monkeypatch.setattr(AE, "evaluate_batches", whole)
    start(read_dump_stream(spark, src, 1), index, sink, chk, version="three").awaitTermination(180)
    rows = spark.read.parquet(sink).collect()
    got = {r["geonameid"]: r["assigned_metro_id"] for r in rows}
    want = {r["geonameid"]: r["assigned_metro_id"] for r in
            assign_metros(pl, rule="share_only").filter(~F.col("isMetro")).collect()}
    assert got == want and len(rows) == len(want)
    assert {r["index_version"] for r in rows} == {"one", "three"}
