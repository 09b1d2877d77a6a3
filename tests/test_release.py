"""Releases: written, verified, damaged."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import functions as F

from quillframe.sources import release


def files(root: Path) -> list[Path]:
    return sorted(p for p in (root / "records").rglob("part-*.json"))


def problems(spark, root) -> dict:
    return {r["path"]: r["problem"] for r in release.verify_release(spark, str(root)).collect()}


def write(spark, root, n=400):
    rows = spark.range(n).selectExpr("id", "concat('name ', id) AS name", "id % 3 AS part_of")
    release.write_release(rows, str(root), F.col("id") % 4, ["id"], {"schema_version": "1", "generated_at": "2024-01-01T00:00:00Z"})
    return rows


def digest_of(path: Path) -> str:
    """The digest by its definition, in plain Python."""
    lines = path.read_bytes().decode().splitlines()
    sums = [sum(int(hashlib.sha256(x.encode()).hexdigest()[8 * k : 8 * k + 8], 16) for x in lines) for k in range(8)]
    return hashlib.sha256(",".join(map(str, [len(lines), *sums])).encode()).hexdigest()


def test_a_whole_release(spark, tmp_path):
    rows = write(spark, tmp_path / "r")
    assert problems(spark, tmp_path / "r") == {}
    listed = {r["path"]: r for r in release.manifest(spark, str(tmp_path / "r")).collect()}
    for f in files(tmp_path / "r"):
        m = listed.pop(str(f.relative_to(tmp_path / "r" / "records")))
        assert (m["bytes"], m["digest"]) == (f.stat().st_size, digest_of(f))
        ids = [json.loads(x)["id"] for x in f.read_text().splitlines()]
        assert ids == sorted(ids) and m["records"] == len(ids)
    assert listed == {}
    head = release.envelope(spark, str(tmp_path / "r"), ["schema_version", "generated_at"]).collect()
    assert [(h["schema_version"], h["records"]) for h in head] == [("1", 400)]
    back = release.records(spark, str(tmp_path / "r"), "id long, name string, part_of long, part long")
    assert sorted(back.select("id", "name", "part_of").collect()) == sorted(rows.collect())


def test_every_damaged_file_is_named(spark, tmp_path):
    root = tmp_path / "r"
    write(spark, root)
    found = files(root)
    assert len(found) >= 4
    name = lambda f: str(f.relative_to(root / "records"))
    one, two, three, four = found[:4]
    one.write_text(one.read_text().replace("name", "nome", 1))
    two.write_text("".join(two.read_text().splitlines(True)[1:]))
    three.unlink()
    four.write_text(four.read_text().replace("\n", "\r\n", 1))
    for f in found[:4]:  # or the checksums of the file system would speak first
        (f.parent / f".{f.name}.crc").unlink()
    extra = root / "records" / "part=9" / "part-extra.json"
    extra.parent.mkdir()
    extra.write_text("{}\n")
    got = problems(spark, root)
    assert got == {name(one): "checksum_mismatch", name(two): "record_count_mismatch", name(three): "missing_artifact", name(four): "size_mismatch", name(extra): "unlisted"}


def test_a_file_of_many_blocks_has_the_same_digest(spark, tmp_path):
    write(spark, tmp_path / "r", 3000)
    want = sorted(release.scan_records(spark, str(tmp_path / "r" / "records")).collect())
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        assert sorted(release.scan_records(spark, str(tmp_path / "r" / "records")).collect()) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_an_empty_release_and_wrong_totals(spark, tmp_path):
    write(spark, tmp_path / "e", 0)
    assert problems(spark, tmp_path / "e") == {}
    write(spark, tmp_path / "r", 10)
    head = next((tmp_path / "r" / "envelope").glob("part-*.json"))
    head.write_text(head.read_text().replace('"records":10', '"records":11'))
    (head.parent / f".{head.name}.crc").unlink()
    assert problems(spark, tmp_path / "r") == {"": "envelope_totals_mismatch"}
