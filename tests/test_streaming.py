"""The streaming split equals the batch split over the same raw files."""

import os

from pyspark.sql import functions as F

from small_tables import SF_SMALL
from lendwise.functions.keys import with_member_key
from lendwise.plans import job
from lendwise.sources import fixture, io
from lendwise.streaming import ingest


def test_split_stream_matches_batch(spark, tmp_dir):
    raw = fixture.raw_loans(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "incoming")
    # two arrivals of raw files
    io.write_csv(raw.filter(F.col("id").cast("long") % 2 == 0), os.path.join(src, "a"))
    io.write_csv(raw.filter(F.col("id").cast("long") % 2 == 1), os.path.join(src, "b"))
    out = os.path.join(tmp_dir, "zones")
    q = ingest.start_split_stream(spark, os.path.join(src, "*"), out,
                                  checkpoint=os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(300)
    keyed = with_member_key(job.read_raw_csv(spark, os.path.join(src, "*")))
    for name, fn in ingest.SPLITS.items():
        got = ingest.read_split(spark, out, name)
        want = fn(keyed)
        assert got.count() == want.count() > 0
        assert got.exceptAll(want.select(*got.columns)).count() == 0
