"""Publication: channel histories, version checks, deterministic archives. Small documents, made on the driver."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import tarfile
from collections.abc import Mapping
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.canonical import semver_key

REQUIRED_MEMBERS = ("manifest.json", "rules.json")


def channel_history(publications: DataFrame) -> DataFrame:
    """Per channel and archive the last publication, with the version active before it and the order in the
    history, which sorts versions as text; ``semver_rank`` is the order of the versions as numbers."""
    by_time = Window.partitionBy("channel").orderBy("sequence")
    rows = publications.withColumn("previous_version", F.lag("pack_version").over(by_time))
    last = rows.groupBy("channel", "archive_hash").agg(F.max_by(F.struct("sequence", "pack_version", "previous_version"), "sequence").alias("x")).select("channel", "archive_hash", "x.*")
    active = publications.groupBy("channel").agg(F.max("sequence").alias("active_sequence"))
    text = Window.partitionBy("channel").orderBy("pack_version", "archive_hash")
    number = Window.partitionBy("channel").orderBy(semver_key(F.col("pack_version")), "archive_hash")
    out = last.join(active, "channel").withColumn("is_active", F.col("sequence") == F.col("active_sequence"))
    return out.withColumn("history_position", F.row_number().over(text).cast("long")).withColumn("semver_rank", F.row_number().over(number).cast("long")).drop("active_sequence")


def gates(packs: DataFrame) -> DataFrame:
    """Packs that may not be published, with the first gate that they miss."""
    why = F.when(F.col("fixtures_failed") > 0, "regression").when(F.col("score") < 4, "score").when(~F.col("channel").isin("experimental", "shadow", "stable"), "channel").when(F.size("lineage") == 0, "lineage")
    return packs.withColumn("gate", why).where("gate is not null")


def safe_member(name: str) -> bool:
    path = PurePosixPath(name)
    return bool(name) and not path.is_absolute() and ".." not in path.parts and "\\" not in name


def archive(members: Mapping[str, bytes]) -> bytes:
    """A tar.gz whose bytes depend on the members alone: sorted names, no times, no owners."""
    if bad := [n for n in members if not safe_member(n)]:
        raise ValueError(f"unsafe member names: {bad}")
    packed = io.BytesIO()
    with tarfile.open(fileobj=packed, mode="w", format=tarfile.USTAR_FORMAT) as tar:
        for name in sorted(members):
            info = tarfile.TarInfo(name)
            info.size, info.mode = len(members[name]), 0o644
            tar.addfile(info, io.BytesIO(members[name]))
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", mtime=0, filename="") as zipped:
        zipped.write(packed.getvalue())
    return out.getvalue()


def manifest(members: Mapping[str, bytes]) -> bytes:
    """Canonical JSON of each member's sha256."""
    return json.dumps({n: hashlib.sha256(b).hexdigest() for n, b in members.items()}, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()


def verify_archive(data: bytes) -> list[str]:
    """What is wrong with an archive; empty if names, owners, times, required members and hashes are right."""
    wrong, members = [], {}
    with tarfile.open(fileobj=io.BytesIO(data), mode="r:gz") as tar:
        for info in tar:
            if not safe_member(info.name) or not info.isfile():
                wrong.append(f"unsafe member {info.name}")
                continue
            if info.mtime or info.uid or info.gid:
                wrong.append(f"metadata of {info.name}")
            members[info.name] = tar.extractfile(info).read()
    wrong += [f"missing {n}" for n in REQUIRED_MEMBERS if n not in members]
    listed = json.loads(members.get("manifest.json", b"{}"))
    wrong += [f"hash of {n}" for n in sorted(set(listed) | set(members) - {"manifest.json"}) if listed.get(n) != hashlib.sha256(members.get(n, b"")).hexdigest()]
    return wrong
