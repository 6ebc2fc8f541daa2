import pytest

from sluicegate import session


class Conf(dict):
    def set(self, k, v):
        self[k] = v


class Fake:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("__", "."): v for k, v in conf.items()})


def test_work_folder_is_the_one_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.work_root(spark) == named
    one, two = session.new_work_dir(spark, "x"), session.new_work_dir(spark, "x")
    assert one != two and one.startswith(f"{named}/x-")
    shared = Fake(spark__checkpoint__dir="hdfs://h/shared/", spark__master="yarn")
    assert session.work_root(shared) == "hdfs://h/shared"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_root(Fake(spark__master="spark://h:7077"))


def test_local_folder_for_a_local_master():
    local = Fake(spark__master="local[8]")
    assert session.work_root(local) == session.work_root(local)


def test_jars_are_a_list():
    assert session.jar_settings([" /a.jar", "/b.jar\n"], ["g:a:1"]) == {
        "spark.jars": "/a.jar,/b.jar",
        "spark.jars.packages": "g:a:1",
    }
    assert session.jar_settings((), ()) == {}
