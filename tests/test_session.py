import pytest

from kontora import session


class _Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


class _Session:
    sparkContext = _Context()

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError):
        session.shared_dir(_Session())


def test_a_single_machine_gets_one(spark):
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
