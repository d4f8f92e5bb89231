"""The shared folder, and stored samples."""

import pytest

from tripstats import session
from tripstats.plans import carriers as C

from .conftest import SF_SMALL


class FakeConf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class FakeSession:
    def __init__(self, **conf):
        self.conf = FakeConf({k.replace("_", "."): v for k, v in conf.items()})
        self.made = []
        self.sparkContext = self

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, path):
        self.made.append(path)


def test_cluster_without_shared_folder_is_refused():
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]", ""):
        with pytest.raises(RuntimeError):
            session.checkpoint_root(FakeSession(spark_master=master))
    for master in ("local", "local[4]", "local[*]", "local[2,3]"):
        fake = FakeSession(spark_master=master)
        assert session.checkpoint_root(fake) == fake.made[0]


def test_broadcast_threshold(spark):
    for text, want in (("10485760b", 10 << 20), ("256k", 256 << 10), ("10MB", 10 << 20), ("-1", -1), ("5", 5)):
        fake = FakeSession()
        fake.conf["spark.sql.autoBroadcastJoinThreshold"] = text
        assert session.broadcast_threshold(fake) == want


def test_stored_sample_is_drawn_once_for_a_table(spark, tmp_path):
    import shutil

    # Not copytree: it would copy the mode of the read-only data folder.
    (tmp_path / "sf").mkdir()
    shutil.copyfile(f"{SF_SMALL}/events.parquet", tmp_path / "sf" / "events.parquet")
    sf = str(tmp_path / "sf")
    first = C.stored_sample(spark, sf, "events")
    again = C.stored_sample(spark, sf, "events")
    assert first.rows.inputFiles() == again.rows.inputFiles() and first.size == again.size
    # a changed table gets a new sample
    spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(700).coalesce(1).write.parquet(str(tmp_path / "other"))
    (tmp_path / "sf" / "events.parquet").unlink()
    part = next(p for p in (tmp_path / "other").iterdir() if p.suffix == ".parquet")
    shutil.copyfile(part, tmp_path / "sf" / "events.parquet")
    spark.catalog.clearCache()
    changed = C.stored_sample(spark, sf, "events")
    assert changed.population == 700
