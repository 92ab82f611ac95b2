"""Intermediate tables never lie on one machine's disk of a cluster."""

import pytest

from tidemark.sources.scratch import NoSharedFolderError, scratch_root


class Session:
    def __init__(self, **conf):
        self.values = {k.replace("_", "."): v for k, v in conf.items()}
        self.conf, self.sparkContext = self, self

    def get(self, name, default=None):
        return self.values.get(name, default)

    def getCheckpointDir(self):
        return self.values.get("set.dir")


WAREHOUSE = "file:/home/user/warehouse"


@pytest.mark.parametrize("master, warehouse, root", [
    ("local[4]", WAREHOUSE, f"{WAREHOUSE}/_scratch/tidemark"),
    ("local", "/home/user/warehouse/", "/home/user/warehouse/_scratch/tidemark"),
    ("yarn", "hdfs://name/warehouse", "hdfs://name/warehouse/_scratch/tidemark"),
    ("spark://host:7077", "s3a://bucket/w", "s3a://bucket/w/_scratch/tidemark"),
])
def test_the_warehouse_where_all_can_see_it(master, warehouse, root):
    conf = {"spark_master": master, "spark_sql_warehouse_dir": warehouse}
    assert scratch_root(Session(**conf)) == root


@pytest.mark.parametrize("master", ["yarn", "local-cluster[3,2,1024]", "spark://host:7077", ""])
@pytest.mark.parametrize("warehouse", [WAREHOUSE, "/home/user/warehouse"])
def test_no_local_folder_on_a_cluster(master, warehouse):
    with pytest.raises(NoSharedFolderError):
        scratch_root(Session(spark_master=master, spark_sql_warehouse_dir=warehouse))
    shared = Session(spark_master=master, spark_sql_warehouse_dir=warehouse, spark_checkpoint_dir="hdfs://name/c/")
    assert scratch_root(shared) == "hdfs://name/c/tidemark"
    assert scratch_root(Session(spark_master=master, spark_sql_warehouse_dir=warehouse, set_dir="s3a://b/c")) == "s3a://b/c/tidemark"
