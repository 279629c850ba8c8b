"""Files as a data source: hashes, blocks, how they are dealt, and memory."""

import hashlib
import subprocess
import sys
from pathlib import Path

import pytest

from evenkeel.sources import artifacts

REPO = Path(__file__).resolve().parents[1]


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    for i, n in enumerate([0, 1, 10, 99, 100, 101, 5000]):
        (tmp_path / ("in" if i % 2 else ".") / f"part-{i}.bin").write_bytes(bytes(x * (i + 1) % 256 for x in range(n)))
    (tmp_path / "_SUCCESS").write_text("")
    (tmp_path / "other.txt").write_text("x")
    return tmp_path


def test_files(spark, folder):
    expected = {p.name: (p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in folder.rglob("*.bin")}
    found = artifacts.scan_artifacts(spark, f"file://{folder}", "part-*").collect()
    assert {r.file_name: (r.byte_length, r.observed_sha256) for r in found} == expected and len(found) == len(expected)
    assert {r.file_name for r in artifacts.scan_artifacts(spark, f"file://{folder}").collect()} == {*expected, "other.txt"}
    one = artifacts.scan_artifacts(spark, f"{folder}/other.txt").collect()
    assert [(r.file_name, r.byte_length) for r in one] == [("other.txt", 1)]


def test_blocks(spark, folder):
    found = artifacts.scan_files(spark, f"file://{folder}", "part-*", 100)
    for r in found.collect():
        data = Path(r.path).read_bytes()
        assert r.byte_length == len(data) and r.start == 100 * r.block and r.block_length == min(100, len(data) - r.start)
        assert r.block_sha256 == hashlib.sha256(data[r.start : r.start + 100]).hexdigest()
    sums = {Path(r.path).name: (r.byte_length, r.blocks) for r in artifacts.block_digest(found).collect()}
    assert sums == {p.name: (p.stat().st_size, max(1, -(-p.stat().st_size // 100))) for p in folder.rglob("*.bin")}


def test_through_a_mount_table(spark, folder):
    """A path that only Hadoop knows is looked up by the driver."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.files.link./in", f"file://{folder}")
    assert artifacts.scan_artifacts(spark, "viewfs://files/in", "part-*").count() == 7


def test_missing_and_empty(spark, tmp_path):
    assert artifacts.scan_artifacts(spark, f"file://{tmp_path}").collect() == []
    with pytest.raises(Exception, match="FileNotFound|does not exist"):
        artifacts.scan_artifacts(spark, f"file://{tmp_path}/none").collect()


def test_dealt_by_size():
    pieces = [(f"f{i}", n, 0, n) for i, n in enumerate([900, 500, 400, 300, 300, 200, 100, 100, 50, 50])]
    loads = [sum(p[3] for p in x) for x in artifacts.dealt(pieces, 3)]
    assert sum(loads) == 2900 and max(loads) - min(loads) <= 150


def test_a_large_file_in_constant_memory(tmp_path):
    """2.2 GB, more than one value of a table may hold, read by one task within 250 MB."""
    with (tmp_path / "large").open("wb") as f:
        f.truncate(2_200_000_000)
    code = f"""
import hashlib, resource
from evenkeel.sources.artifacts import ArtifactReader
reader = ArtifactReader({{"path": "file://{tmp_path}"}})
rows = [r for p in reader.partitions() for r in reader.read(p)]
print(rows[0][2], rows[0][3], resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, check=True).stdout.split()
    h, zeros = hashlib.sha256(), bytes(10_000_000)
    for _ in range(220):
        h.update(zeros)
    assert out[0] == "2200000000" and out[1] == h.hexdigest() and int(out[2]) < 250
