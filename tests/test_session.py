from clickvault.session import MB, recommended_conf, silver_buckets_for

TB = 1024 * 1024 * MB


def test_bucket_sizing():
    assert silver_buckets_for(0) == 8
    assert silver_buckets_for(270 * 1024 * MB) == 4096  # ~100 TB a year, per day
    assert silver_buckets_for(1000 * MB) == 8


def test_recommended_conf_scales_with_data():
    small = recommended_conf(1 * MB, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "24"
    big = recommended_conf(100 * TB, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * TB // (128 * MB)
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_configured_checkpoint_dir_is_used(tmp_path):
    """A session that names spark.checkpoint.dir (as a cluster does) keeps it:
    local_session does not override it and checkpoints land there."""
    import os
    import subprocess
    import sys
    import textwrap

    shared = tmp_path / "shared-ckpt"
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
        from clickvault.session import checkpoint_dir, checkpoint_reliably, local_session
        spark = local_session(cores=2, extra={{"spark.checkpoint.dir": {str(shared)!r}}})
        assert checkpoint_dir(spark) == {str(shared)!r}, checkpoint_dir(spark)
        checkpoint_reliably(spark.range(10)).count()
        spark.stop()
    """)
    r = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    written = [p for p in shared.rglob("*") if p.is_file()]
    assert written, "no checkpoint files under the configured folder"
