import os
import tempfile

from dfinsight.session import build_session, checkpoint_dir, clean_scratch, scratch_path


def test_scratch_paths_live_under_the_checkpoint_dir_and_are_cleaned():
    # a session of its own with its own checkpoint folder, so cleaning touches nothing else
    base = tempfile.mkdtemp(prefix="dfinsight-ckpt-test-")
    spark = build_session("local[2]", 2, app="dfinsight-session-test")
    sc = spark.sparkContext
    old = sc.getCheckpointDir()
    try:
        sc.setCheckpointDir(base)
        root = checkpoint_dir(spark)
        p = scratch_path(spark, "x")
        assert p.startswith(root.rstrip("/") + "/dfinsight/x-")
        spark.range(3).write.parquet(p)
        local = p.removeprefix("file:")
        assert os.path.isdir(local)
        assert clean_scratch(spark) is True
        assert not os.path.exists(local)
        assert clean_scratch(spark) is False
    finally:
        if old:
            sc.setCheckpointDir(old)
