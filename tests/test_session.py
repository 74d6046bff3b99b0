"""The library uses the cluster's shared checkpoint folder when one is named."""

from emporion.session import ensure_checkpoint_dir, scratch_path


def test_checkpoint_folder_comes_from_the_session(spark):
    base = ensure_checkpoint_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert base == configured
    else:
        assert base == spark.sparkContext.getCheckpointDir()
    assert spark.sparkContext.getCheckpointDir() is not None
    assert scratch_path(spark, "models", "run1") == f"{base.rstrip('/')}/models/run1"
    # idempotent
    assert ensure_checkpoint_dir(spark) == base
