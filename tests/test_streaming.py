"""P4 as a stream: new listing files are linked to maps incrementally."""

import os

from pyspark.sql import functions as F

from sectionmap.plans import files as FL
from sectionmap.plans.staging import Staging
from sectionmap.streaming.listing import link_stream
from tests.conftest import SF001


def test_listing_stream_matches_batch(spark, tmp_path):
    st = Staging(spark, SF001)
    listing = tmp_path / "listing"
    listing.mkdir()
    paths = [r["path"] for r in st.inp.f_file.collect()]
    half = len(paths) // 2
    (listing / "part-1.txt").write_text("\n".join(paths[:half]) + "\n")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = link_stream(spark, str(listing), st.maps, st.maptype, "map", out, ckpt)
    q.awaitTermination()
    (listing / "part-2.txt").write_text("\n".join(paths[half:]) + "\n")
    q = link_stream(spark, str(listing), st.maps, st.maptype, "map", out, ckpt)
    q.awaitTermination()
    streamed = spark.read.parquet(out)
    batch = FL.link_files(st.inp.f_file, st.maps, st.maptype, "map")
    key = ["kind", "path", "map_id", "page"]
    assert streamed.count() == batch.count() == len(paths)
    assert streamed.select(*key).exceptAll(batch.select(*key)).count() == 0
    assert os.path.isdir(os.path.join(ckpt, "offsets"))
