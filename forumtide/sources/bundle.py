"""Release bundles: write once, verify by checksum, find the latest complete one."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumtide.sources.contracts import (
    RELEASE_CONTRACTS,
    Contract,
    ContractError,
    assert_contract,
    judge,
    judged_rows,
    judged_violations,
    read_strings,
)
from forumtide.session import materialize

MANIFEST = "SHA256SUMS.txt"
RELEASE_PREFIX = "release="
# Rows per data file. A checksum reads a whole file, so files are kept far below 2 GB.
ROWS_PER_FILE = 500_000


def _filesystem(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def file_digests(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``(name, sha256)`` of every data file below ``root``, names relative to it."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    base = re.escape(re.sub(r"^[a-z0-9]+:/*", "/", root).rstrip("/"))
    name = F.regexp_replace("path", rf"^.*?{base}/", "")
    return files.select(name.alias("name"), F.sha2("content", 256).alias("sha256")).where(
        F.col("name") != MANIFEST
    )


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Checksum list as ``(name, sha256, valid)``."""
    lines = spark.read.text(f"{root.rstrip('/')}/{MANIFEST}").where(F.trim("value") != "")
    parts = F.split(F.trim("value"), r"\s+")
    digest = F.lower(F.get(parts, F.lit(0)))
    return lines.select(
        F.regexp_replace(F.get(parts, F.lit(1)), r"^\*+", "").alias("name"),
        digest.alias("sha256"),
        ((F.size(parts) == 2) & (F.length(digest) == 64)).alias("valid"),
    )


def integrity(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Status per member: ``ok``, ``missing``, ``unexpected``, ``mismatch``, ``duplicate``."""
    listed = manifest.groupBy("name").agg(
        F.max("sha256").alias("expected"), F.count(F.lit(1)).alias("_n")
    )
    actual = files.groupBy("name").agg(
        F.max("sha256").alias("actual"), F.count(F.lit(1)).alias("_m")
    )
    status = (
        F.when(F.col("actual").isNull(), "missing")
        .when(F.col("expected").isNull(), "unexpected")
        .when((F.col("_n") > 1) | (F.col("_m") > 1), "duplicate")
        .when(F.col("actual") == F.col("expected"), "ok")
        .otherwise("mismatch")
    )
    return listed.join(actual, "name", "full_outer").select(
        "name", "expected", "actual", status.alias("status")
    )


def verify_release(spark: SparkSession, root: str) -> None:
    """Raise unless every listed file is present and unchanged and no other is there."""
    manifest = read_manifest(spark, root)
    if manifest.where(~F.col("valid")).take(1):
        raise ContractError("checksum list has an invalid entry")
    bad = integrity(file_digests(spark, root), manifest).where("status <> 'ok'").limit(10).collect()
    if bad:
        raise ContractError(", ".join(f"{r['name']}: {r['status']}" for r in bad))


def write_release(datasets: dict[str, DataFrame], root: str, release: str) -> str:
    """Publish one coherent release as CSV datasets with a checksum list.

    Everything is written to a staging folder and renamed at the end, so readers see a
    whole release or none. A release is never replaced.
    """
    names = {contract.name for contract in RELEASE_CONTRACTS}
    if set(datasets) != names:
        raise ContractError("a release holds exactly the contracted datasets")
    spark = next(iter(datasets.values())).sparkSession
    target = f"{root.rstrip('/')}/{RELEASE_PREFIX}{release}"
    fs, target_path = _filesystem(spark, target)
    if fs.exists(target_path):
        raise FileExistsError(f"release already exists: {target}")
    staging = f"{root.rstrip('/')}/_staging-{release}-{uuid.uuid4().hex}"
    for contract in RELEASE_CONTRACTS:
        frame = datasets[contract.name].select(*contract.columns)
        (
            frame.write.option("header", "true").option("escape", '"')
            .option("maxRecordsPerFile", ROWS_PER_FILE)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
            .csv(f"{staging}/{contract.name}")
        )
        _drop_markers(spark, f"{staging}/{contract.name}")
    sums = file_digests(spark, staging).select(F.concat_ws("  ", "sha256", "name").alias("value"))
    _write_manifest(spark, sums, staging)
    _, staging_path = _filesystem(spark, staging)
    if not fs.rename(staging_path, target_path):
        raise OSError(f"could not publish {target}")
    return target


def _write_manifest(spark: SparkSession, lines: DataFrame, staging: str) -> None:
    """The checksum list as one text file, written by one task and then named.

    It has a line per data file; no line passes the driver.
    """
    parts = f"{staging.replace('_staging-', '_sums-')}"
    lines.sort("value").coalesce(1).write.text(parts)
    fs, written = _filesystem(spark, f"{parts}/part-*.txt")
    found = fs.globStatus(written)
    fs.rename(found[0].getPath(), _filesystem(spark, f"{staging}/{MANIFEST}")[1])
    fs.delete(_filesystem(spark, parts)[1], True)


def _drop_markers(spark: SparkSession, folder: str) -> None:
    fs, path = _filesystem(spark, f"{folder}/_SUCCESS")
    if fs.exists(path):
        fs.delete(path, False)


def latest_release(spark: SparkSession, location: str) -> str:
    """Newest complete release by name; a path that is itself a release passes through."""
    fs, path = _filesystem(spark, f"{location.rstrip('/')}/{MANIFEST}")
    if fs.exists(path):
        return location
    found = fs.globStatus(
        spark._jvm.org.apache.hadoop.fs.Path(f"{location.rstrip('/')}/{RELEASE_PREFIX}*/{MANIFEST}")
    )
    folders = sorted(status.getPath().getParent().getName() for status in (found or []))
    if not folders:
        raise FileNotFoundError(f"no complete release under {location}")
    return f"{location.rstrip('/')}/{folders[-1]}"


def newest_complete(manifests: DataFrame) -> DataFrame:
    """Rows of the newest release name in a manifest table."""
    newest = manifests.agg(F.max("release").alias("release")).scalar()
    return manifests.where(F.col("release") == newest)


def read_release(
    spark: SparkSession, location: str, host: str | None = None, verify: bool = True
) -> dict[str, DataFrame]:
    """Typed datasets of the latest release, refused when any contract is broken."""
    root = latest_release(spark, location)
    if verify:
        verify_release(spark, root)
    frames = {}
    for contract in RELEASE_CONTRACTS:
        frames[contract.name] = read_dataset(spark, f"{root}/{contract.name}", contract, host)
    return frames


def read_dataset(
    spark: SparkSession, path: str, contract: Contract, host: str | None = None
) -> DataFrame:
    """Typed rows of one dataset. The files are parsed and judged once; this runs jobs."""
    judged = materialize(judge(read_strings(spark, path, contract), contract, host), contract.name)
    assert_contract(judged_violations(judged, contract))
    return judged_rows(judged, contract)
