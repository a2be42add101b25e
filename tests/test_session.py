import os
from types import SimpleNamespace

import pytest

from punctual import session


def test_shared_paths_are_removed(spark, tmp_path):
    where = session.shared_path(spark, "x")
    spark.range(3).write.parquet(where)
    assert spark.read.parquet(where).count() == 3
    assert session.release(spark) >= 1 and not os.path.exists(where.removeprefix("file:"))
    assert session.release(spark) == 0


@pytest.mark.parametrize(("master", "fine"), [("local", True), ("local[4]", True), ("local-cluster[2,1,900]", False), ("yarn", False), ("spark://h:7077", False)])
def test_a_cluster_must_name_its_shared_folder(master, fine):
    made = []
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=made.append)
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda name, default: default))
    if fine:
        assert session.shared_dir(fake) == made[0]
        os.rmdir(made[0].removeprefix("file://"))
    else:
        with pytest.raises(ValueError):
            session.shared_dir(fake)
