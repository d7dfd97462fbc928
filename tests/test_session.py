from millstar.session import ensure_checkpoint_dir, scratch_path, shuffle_partitions


def test_scratch_lives_under_the_session_checkpoint_dir(spark):
    root = ensure_checkpoint_dir(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root.rstrip("/") + "/millstar-scratch/x-") and a != b


def test_shuffle_partitions_parsing(spark):
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        assert shuffle_partitions(spark) == 12
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    assert shuffle_partitions(spark) == int(prev)


def test_only_local_sessions_get_a_folder_of_their_own(monkeypatch):
    import pytest

    from millstar import session

    assert session.is_local("local") and session.is_local("local[8]")
    assert not session.is_local("local-cluster[3,2,1024]") and not session.is_local("spark://host:7077")

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
