"""The command line drives the same jobs end to end."""

import os

from vigil.cli import main
from vigil.sources.shards import read_protected


def _write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_cli_end_to_end(spark, tmp_dir):
    _write(f"{tmp_dir}/keys/id.hex", (bytes(range(32)).hex() + "\n").encode())
    _write(f"{tmp_dir}/keys/secret.hex", bytes(range(32, 64)).hex().encode())
    _write(f"{tmp_dir}/in/a.txt", b"a@x.test:p1\nb@x.test:5f4dcc3b5aa765d61d8327deb882cf99\nc@x.test:p3\n")
    keys = ["--id-key", f"{tmp_dir}/keys/id.hex", "--secret-key", f"{tmp_dir}/keys/secret.hex"]
    out = f"{tmp_dir}/ds"
    assert main(["ingest", "--input", f"{tmp_dir}/in", "--out", out, "--batch-id", "0", *keys], spark) == 0
    recs = read_protected(spark, f"{out}/records")
    assert recs.count() == 3
    recs.select("id_digest").write.parquet(f"{tmp_dir}/watch")
    assert main(["check", "--records", f"{out}/records", "--watchlist", f"{tmp_dir}/watch",
                 "--output", f"{tmp_dir}/report"], spark) == 0
    rep = spark.read.option("header", "true").csv(f"{tmp_dir}/report")
    assert rep.count() == 3 and rep.where("exposed = 'true'").count() == 3
    assert main(["profile", "--records", f"{out}/records", "--output", f"{tmp_dir}/prof"], spark) == 0
    assert main(["dedupe", "--src", f"{out}/records", "--dst", f"{tmp_dir}/v2"], spark) == 0
    assert main(["compact", "--src", f"{tmp_dir}/v2", "--dst", f"{tmp_dir}/v2json", "--format", "json"], spark) == 0
    assert read_protected(spark, f"{tmp_dir}/v2json", fmt="json").count() == 3
    assert main(["audit", "--records", f"{out}/records"], spark) == 0
    assert main(["pending", "--input", f"{tmp_dir}/in", "--out", out, "--output", f"{tmp_dir}/pend"], spark) == 0
    assert spark.read.option("header", "true").csv(f"{tmp_dir}/pend").count() == 0
    assert main(["maintenance-due", "--out", out], spark) == 0
    assert main(["storage", "--path", f"{out}/records", "--glob", "*.parquet"], spark) == 0


def test_cli_stream_drains_and_resumes(spark, tmp_dir):
    _write(f"{tmp_dir}/keys/id.hex", bytes(range(32)).hex().encode())
    _write(f"{tmp_dir}/keys/secret.hex", bytes(range(32, 64)).hex().encode())
    keys = ["--id-key", f"{tmp_dir}/keys/id.hex", "--secret-key", f"{tmp_dir}/keys/secret.hex"]
    args = ["stream", "--input", f"{tmp_dir}/inbox", "--out", f"{tmp_dir}/ds", "--checkpoint", f"{tmp_dir}/ckpt", *keys]
    _write(f"{tmp_dir}/inbox/a.txt", b"a@x.test:p1\nb@x.test:p2\n")
    assert main(args, spark) == 0
    _write(f"{tmp_dir}/inbox/b.txt", b"c@x.test;p3\nd@x.test;p4\n")
    assert main(args, spark) == 0
    assert read_protected(spark, f"{tmp_dir}/ds/records").count() == 4
