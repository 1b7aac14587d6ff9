import pyarrow as pa
import pytest

from conftest import DATA
from nestra.sources import readers, writers
from nestra.streaming import masks as stream


def test_arrow_files(spark, tmp_path):
    t = pa.table({"event_id": [1, 2], "x": [[1.0], None]})
    for name, new in (("s", pa.ipc.new_stream), ("f", pa.ipc.new_file)):
        with new(str(tmp_path / name), t.schema) as w:
            w.write_table(t)
    df = readers.read_arrow_files(spark, [str(tmp_path / n) for n in ("s", "missing", "f")])
    assert sorted((r.event_id, r.x) for r in df.collect() if r.x) == [(1, [1.0]), (1, [1.0])] and df.count() == 4
    assert readers.read_arrow_files(spark, ["/nowhere"]) is None


def test_catalogue_and_rename(spark):
    c = readers.read_catalogue(spark, DATA, ("particles", "tracks"), n_events=3)
    assert c["particles"].select("event_id").distinct().count() == 3
    assert readers.rename(c["tracks"], {"phi": "track_phi"}).columns == ["track_phi"]
    with pytest.raises(ValueError):
        readers.rename(c["tracks"], {"nope": "x"})


def test_root_needs_a_library(spark):
    with pytest.raises(ImportError):
        readers.read_root(spark, "/nowhere", "t", {})


def test_written_is_read(spark, make, tmp_path):
    t = make.tracks(*[{"event_id": k, "majority_particle_id": [k], "phi": [0.5], "theta": [1.0]} for k in range(25)])
    writers.write_jagged(t.coalesce(1), str(tmp_path / "o"), chunk=10)
    back = spark.read.parquet(str(tmp_path / "o"))
    assert back.count() == 25 and dict(back.dtypes)["phi"] == "array<float>" and dict(back.dtypes)["majority_particle_id"] == "array<int>"
    assert len(list((tmp_path / "o").glob("*.parquet"))) == 3
    with pytest.raises(ValueError):
        writers.narrow(spark.sql("select map(1, 2) as m"))


def test_stream_of_blocks(spark, make, tmp_path):
    p = make.particles(make.forest(1, (1, None, False), (2, 1, True)), make.forest(1, (1, None, False), (2, 1, True)))
    p.write.parquet(str(tmp_path / "in"))
    blocks = stream.distinct_deliveries(stream.stream_particles(spark, str(tmp_path / "in")))
    q = stream.with_masks(blocks).writeStream.format("memory").queryName("masks_out").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    out = spark.table("masks_out").collect()
    assert [r.created_inside_calo for r in out] == [[False, True]]
