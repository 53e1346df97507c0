"""A bounded stream reads its batches by more than one task."""

from pathlib import Path

from newslake.catalog import QUERIES
from newslake.session import shared_dir


def test_bounded_stream_has_a_file_for_each_core(spark, sf):
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.glob("stream-bounded-*"))
    counted = QUERIES["stream_bounded"](spark, sf).first()
    (made,) = set(folder.glob("stream-bounded-*")) - before
    assert counted.messages == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert len(list((made / "in").glob("*.parquet"))) > 5
    assert len(list((made / "out").glob("batch=*"))) >= 5
