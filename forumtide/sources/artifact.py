"""Labelled artifacts: versioned folders with the manifest row written last.

Whole normalised texts stand beside the artifacts in one store per root, keyed by content hash:
a text is stored once however many runs, posts or comments have it, and an artifact keeps links
(row key, hash). So labels can follow a new lexicon without the sources being read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumtide.functions.text import digest
from forumtide.operators.merge import POST_KEY
from forumtide.registry import SelectionPolicy
from forumtide.schemas import ARTIFACT_COMMENT, ARTIFACT_POST
from forumtide.session import materialize

SCHEMA_VERSION = 1
MANIFEST_COLUMNS = (
    "schema_version INT, source_sha256 STRING, model_version STRING, policy_version STRING, "
    "window_days INT, job_per_metric INT, general_per_metric INT, complete BOOLEAN, "
    "folder STRING, generated_at TIMESTAMP_NTZ"
)
COMMENT_KEY = (*POST_KEY, "comment_id")
TEXT = "content_hash STRING, whole_text STRING"
BODY_LINK = "board_id INT, post_id BIGINT, content_hash STRING"
COMMENT_LINK = "board_id INT, post_id BIGINT, comment_id BIGINT, content_hash STRING"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or an empty one of its schema before it is first written."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """All manifest rows, or an empty table before the first run."""
    return _stored(spark, f"{root.rstrip('/')}/manifests", MANIFEST_COLUMNS)


def matching_manifests(manifests: DataFrame, source_sha256: str) -> DataFrame:
    return manifests.where(
        (F.col("schema_version") == SCHEMA_VERSION) & (F.col("source_sha256") == source_sha256)
    )


def is_current(
    manifests: DataFrame, source_sha256: str, policy: SelectionPolicy, model_version: str
) -> DataFrame:
    """One row: is there a complete artifact for exactly these inputs."""
    same = matching_manifests(manifests, source_sha256).where(
        F.col("complete")
        & (F.col("model_version") == model_version)
        & (F.col("policy_version") == policy.version)
        & (F.col("window_days") == policy.window_days)
        & (F.col("job_per_metric") == policy.job_per_metric)
        & (F.col("general_per_metric") == policy.general_per_metric)
    )
    return same.agg((F.count(F.lit(1)) > 0).alias("current"))


def write_artifact(
    posts: DataFrame, comments: DataFrame, root: str, source_sha256: str,
    policy: SelectionPolicy, model_version: str, complete: bool, generated_at,
    body_texts: DataFrame | None = None, comment_texts: DataFrame | None = None,
) -> str:
    """Store one labelling result, with the whole texts behind it if they are given.

    Data go to a new folder that no plan is reading; the manifest row that makes it
    visible is appended last, so a lost job leaves the previous artifact in force.
    ``complete`` should be false when any post failed, so that it is tried again.
    """
    spark = posts.sparkSession
    base = root.rstrip("/")
    folder = f"source={source_sha256}/model={model_version}/run={uuid.uuid4().hex}"
    posts.write.parquet(f"{base}/data/{folder}/posts")
    comments.write.parquet(f"{base}/data/{folder}/comments")
    if body_texts is not None and comment_texts is not None:
        bodies = store_texts(body_texts, base)
        notes = store_texts(comment_texts, base)
        bodies.select(*POST_KEY, "content_hash").write.parquet(f"{base}/data/{folder}/bodies")
        notes.select(*COMMENT_KEY, "content_hash").write.parquet(f"{base}/data/{folder}/notes")
    row = (
        SCHEMA_VERSION, source_sha256, model_version, policy.version, policy.window_days,
        policy.job_per_metric, policy.general_per_metric, complete, folder, generated_at,
    )
    spark.createDataFrame([row], MANIFEST_COLUMNS).coalesce(1).write.mode("append").parquet(
        f"{base}/manifests"
    )
    return folder


def store_texts(rows: DataFrame, root: str) -> DataFrame:
    """Append the texts that the store of this root does not have yet; the rows' hashes.

    ``rows`` have ``whole_text``, null meaning empty. They are read once and kept beside their
    hash while this runs. A run that stops after it leaves texts that no link names; the next
    one finds them and does not store them again.
    """
    spark, path = rows.sparkSession, f"{root.rstrip('/')}/texts"
    text = F.coalesce("whole_text", F.lit(""))
    hashed = materialize(
        rows.withColumn("whole_text", text).withColumn("content_hash", digest(text)), "texts"
    )
    known = _stored(spark, path, TEXT).select("content_hash")
    new = hashed.join(known, "content_hash", "left_anti").groupBy("content_hash").agg(
        F.any_value("whole_text").alias("whole_text")
    )
    new.write.mode("append").parquet(path)
    return hashed.drop("whole_text")


def _newest_folder(spark: SparkSession, root: str, source_sha256: str) -> str | None:
    newest = (
        matching_manifests(read_manifests(spark, root), source_sha256)
        .orderBy(F.desc("generated_at"), F.desc("folder"))
        .select("folder")
        .take(1)
    )
    return f"{root.rstrip('/')}/data/{newest[0]['folder']}" if newest else None


def read_artifact(
    spark: SparkSession, root: str, source_sha256: str
) -> tuple[DataFrame, DataFrame]:
    """Newest stored posts and comments for this source; empty typed tables if none."""
    base = _newest_folder(spark, root, source_sha256)
    if base is None:
        return spark.createDataFrame([], ARTIFACT_POST), spark.createDataFrame([], ARTIFACT_COMMENT)
    return (
        spark.read.schema(ARTIFACT_POST).parquet(f"{base}/posts"),
        spark.read.schema(ARTIFACT_COMMENT).parquet(f"{base}/comments"),
    )


def read_texts(spark: SparkSession, root: str, source_sha256: str) -> tuple[DataFrame, DataFrame]:
    """Whole texts of the newest artifact's posts and comments, by row key.

    Rows whose text is not in the store are missing, all of them in an artifact that was
    written without texts. Only the texts that links name are read beyond their hash column.
    """
    base = _newest_folder(spark, root, source_sha256) or f"{root.rstrip('/')}/none"
    bodies = _stored(spark, f"{base}/bodies", BODY_LINK)
    notes = _stored(spark, f"{base}/notes", COMMENT_LINK)
    named = bodies.select("content_hash").unionByName(notes.select("content_hash"))
    # Runs side by side may both have stored a text.
    texts = materialize(
        _stored(spark, f"{root.rstrip('/')}/texts", TEXT)
        .join(named, "content_hash", "left_semi")
        .groupBy("content_hash").agg(F.any_value("whole_text").alias("whole_text")),
        "named-texts",
    )
    return (
        bodies.join(texts, "content_hash").drop("content_hash"),
        notes.join(texts, "content_hash").drop("content_hash"),
    )
