import pytest

from moorage import session
from moorage.spec import CsvLoad, as_count, as_flag, preset, preset_names, with_options


def test_presets():
    assert preset("TRANSACTIONS").query == {"valueDate": {"$gte": 1735689600000}}
    assert preset("STORES").fields == ("_id", "address", "merchantId", "storeId", "storeName")
    assert preset("transactions").field_mapping == {"AMOUNT": "Amount"}
    assert preset("DATA_SOURCE_2").pattern == r".*/data_source_file_02.*\.csv"
    assert len(preset_names()) == 6
    with pytest.raises(ValueError):
        preset("none")


def test_options():
    assert [as_flag(x) for x in ("true", "YES", "1", "no", "", True, None)] == [True, True, True, False, False, True, False]
    assert [as_count(x) for x in ("5", 5, "", None)] == [5, 5, None, None]
    load = with_options(preset("DATA_SOURCE_1"), {"dry_run": "yes", "max_files": "3", "workers": 9}, {"max_files": "", "load_mode": "daily"})
    assert (load.dry_run, load.max_files, load.load_mode, load.start_date) == (True, None, "daily", "2025-01-01")
    assert with_options(preset("STORES"), {"upsert": "false", "batch_size": None}).mode == "append"
    assert with_options(preset("STORES"), {"upsert": "1", "batch_size": "10"}).batch_size == 10
    assert with_options(CsvLoad(table="t"), None) == CsvLoad(table="t")


class Session:
    """A session with nothing but what the choice of the folder looks at."""

    def __init__(self, named=None, master="local[2]"):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = self
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_the_shared_folder_is_the_one_the_session_names():
    assert session.shared_dir(Session("hdfs://shared/dir/")) == "hdfs://shared/dir"
    local = Session()
    assert session.shared_dir(local) == session.shared_dir(local) == local.folder
    with pytest.raises(ValueError):
        session.shared_dir(Session(master="yarn"))


def test_stored_tables_lie_in_the_shared_folder(spark):
    stored = session.materialise(spark.range(5), "five")
    assert f"{session.shared_dir(spark)}/moorage/five-" in stored.inputFiles()[0]
    assert stored.count() == 5
