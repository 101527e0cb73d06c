"""No sink, checkpoint or plan text holds a clear identifier, secret or key."""

import gzip
import os

from vigil.operators.protect import TEST_KEYS
from vigil.plans.ingest import Outputs, ingest_files
from vigil.streaming.ingest import run_available

SECRETS = ["Tr0ub4dor&3", "hunter2-secret", "5f4dcc3b5aa765d61d8327deb882cf99"]
ADDRESSES = ["alice.leak@example.com", "bob.leak@example.test", "carol.leak@example.com"]


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _all_bytes(root):
    for d, _, files in os.walk(root):
        for name in files:
            with open(os.path.join(d, name), "rb") as f:
                data = f.read()
            if name.endswith(".gz"):
                data = gzip.decompress(data)
            yield os.path.join(d, name), data


def test_no_clear_text_in_outputs_or_checkpoints(spark, tmp_dir):
    lines = "\n".join(f"{a}:{s}" for a, s in zip(ADDRESSES, SECRETS)) + "\n"
    _write(f"{tmp_dir}/in/a.txt", lines)
    _write(f"{tmp_dir}/inbox/b.txt", lines.replace(":", ";"))
    out = Outputs(f"{tmp_dir}/out")
    ingest_files(spark, f"{tmp_dir}/in", out, TEST_KEYS, batch_id=0)
    run_available(spark, f"{tmp_dir}/inbox", Outputs(f"{tmp_dir}/out2"), f"{tmp_dir}/ckpt", TEST_KEYS)
    ckpt_root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    needles = [x.encode() for x in SECRETS + ADDRESSES + [a.split("@")[0] for a in ADDRESSES]]
    needles += [TEST_KEYS.identifier.material, TEST_KEYS.secret.material]
    needles += [TEST_KEYS.identifier.material.hex().encode(), TEST_KEYS.secret.material.hex().encode()]
    scanned = 0
    for root in (f"{tmp_dir}/out", f"{tmp_dir}/out2", f"{tmp_dir}/ckpt", ckpt_root):
        for path, data in _all_bytes(root):
            scanned += 1
            for n in needles:
                assert n not in data, (path, n)
    assert scanned > 10
