"""The stream's batches follow the lots, not the number of files."""

import os

from lendwise.plans import registry
from lendwise.plans.stages import Stages
from small_tables import SF_SMALL


def test_a_stream_batch_holds_a_lot(spark, tmp_dir, monkeypatch):
    """Four batches however many files a lot has."""
    monkeypatch.setattr(registry, "scratch_path", lambda _, *parts: "/".join([tmp_dir, *parts]))
    keyed = Stages.from_testdata(spark, SF_SMALL).keyed.repartition(6)
    monkeypatch.setattr(registry, "stages", lambda *_: Stages(keyed, raw_is_keyed=True))
    assert registry.QUERIES["stream_dup_members"](spark, SF_SMALL).count() > 0
    assert len(os.listdir(f"{tmp_dir}/incoming/lot0")) > 6
    assert len([x for x in os.listdir(f"{tmp_dir}/stream-zones/keyed") if x.startswith("batch_id")]) == 4
