"""All-or-nothing publishing of score tables and alerts.

A publish writes each table to a folder of its own and, as the last step, adds
one numbered entry to the release log. Readers follow the entry with the highest number, so they see either
the complete new release or the complete old one; a failed run leaves no entry. An entry is created only
where its number is free: of publishers that run at once one gets the number, the others start over from the release it
made, so no table is lost.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from clientela.functions.sketch import PARTS, RankSketch
from clientela.sources.tables import table_exists

RELEASE_LOG = "releases"
# Entries that stay: each holds the whole release, older ones only keep their numbers taken.
LOG_KEPT = 200
LOG_SCHEMA = "number bigint, release string, published_at timestamp, tables map<string,string>"

SCORE_SCHEMAS = {
    "anomaly_scores": (
        "customer_hash string, anomaly_score double, is_anomaly boolean, "
        "anomaly_flag string, scored_at timestamp"
    ),
    "churn_scores": (
        "customer_hash string, churn_probability double, predicted_churn boolean, "
        "scored_at timestamp"
    ),
    "segment_assignments": (
        "customer_hash string, cluster_id int, segment_label string, assigned_at timestamp"
    ),
}


ALERT_SCHEMA = (
    "id bigint, customer_hash string, alert_type string, score double, threshold double, "
    "created_at timestamp, is_resolved boolean, notes string"
)


def _stamped(df: DataFrame, table: str, now: datetime) -> DataFrame:
    """Cast to the published types; the last column is the time stamp."""
    *fields, stamp = [part.strip().split(" ") for part in SCORE_SCHEMAS[table].split(",")]
    return df.select(
        *[F.col(name).cast(kind).alias(name) for name, kind in fields],
        F.lit(now).cast("timestamp").alias(stamp[0]),
    )


def require_unique(df: DataFrame, key: str) -> None:
    """Fail where ``key`` is null or repeats (the published tables' primary key)."""
    repeated = df.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull())
    bad = repeated.limit(1).collect()
    if bad:
        raise ValueError(f"{key} is not a key: {bad[0][key]!r} occurs {bad[0]['count']} times")


def stage_scores(df: DataFrame, table: str, folder: str, now: datetime | None = None) -> DataFrame:
    """Write one score table to ``folder`` after the key check; returns it as stored."""
    published = _stamped(df, table, now or datetime.now(UTC))
    published.write.mode("overwrite").parquet(folder)
    stored = df.sparkSession.read.parquet(folder)
    require_unique(stored, "customer_hash")
    return stored


def publish_anomaly_scores(df: DataFrame, folder: str, now: datetime | None = None) -> DataFrame:
    return stage_scores(df, "anomaly_scores", folder, now)


def publish_churn_scores(df: DataFrame, folder: str, now: datetime | None = None) -> DataFrame:
    return stage_scores(df, "churn_scores", folder, now)


def publish_segment_assignments(df: DataFrame, folder: str, now: datetime | None = None) -> DataFrame:
    return stage_scores(df, "segment_assignments", folder, now)


def _entry(root: str, number: int) -> str:
    return f"{root}/{RELEASE_LOG}/{number:020d}.json"


def _path(spark: SparkSession, path: str):
    """A path for the file system's own calls, and that file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def entry_numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the log's entries, rising."""
    place, files = _path(spark, f"{root}/{RELEASE_LOG}")
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(int(n[:20]) for n in names if re.fullmatch("[0-9]{20}[.]json", n))


def newest_line(spark: SparkSession, root: str) -> Row | None:
    """The log entry with the highest commit number; none before the first release."""
    numbers = entry_numbers(spark, root)
    # Logs of earlier versions are appended lines.
    source = _entry(root, numbers[-1]) if numbers else f"{root}/{RELEASE_LOG}"
    try:
        log = spark.read.schema(LOG_SCHEMA).json(source)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = log.orderBy(F.desc_nulls_last("number"), F.desc("release")).limit(1).collect()
    return newest[0] if newest else None


def create_entry(spark: SparkSession, root: str, line: dict) -> bool:
    """Add an entry unless its number is taken; whether it was added.

    The entry is written under a hidden name and renamed without overwriting, which the file system does at
    once or not at all: no reader meets half an entry, and no two publishers get one number.
    """
    draft, files = _path(spark, f"{root}/{RELEASE_LOG}/.{line['release']}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(line).encode()))
    out.close()
    target, _ = _path(spark, _entry(root, line["number"]))
    kinds = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark._sc._gateway.new_array(kinds, 1)
    how[0] = kinds.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(target), how)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        files.delete(draft, False)
        return False
    return True


def compact_log(spark: SparkSession, root: str, kept: int = LOG_KEPT) -> None:
    """Delete all but the newest ``kept`` entries."""
    for number in entry_numbers(spark, root)[:-kept]:
        place, files = _path(spark, _entry(root, number))
        files.delete(place, False)


def current_release(spark: SparkSession, root: str) -> dict[str, str]:
    """Folder of each table in the newest release; empty before the first one."""
    newest = newest_line(spark, root)
    return dict(newest["tables"]) if newest else {}


def commit_release(
    spark: SparkSession,
    root: str,
    changed: dict[str, str],
    now: datetime,
    derived: Callable[[dict[str, str]], dict[str, str]] | None = None,
) -> dict[str, str]:
    """Make the changed tables current, all others stay; called when all of them exist. Returns the release.

    ``derived`` writes tables that follow from the whole release. If another publisher takes the number
    meanwhile, the release is made again on top of theirs, derived tables too. Entries are ordered by
    number. ``now`` stamps the data only, so a second publish with the same or an older stamp still becomes current.
    """
    while True:
        newest = newest_line(spark, root)
        number = (newest["number"] or 0) + 1 if newest else 1
        tables = {**(dict(newest["tables"]) if newest else {}), **changed}
        if derived:
            tables |= derived(tables)
        line = {"number": number, "release": uuid.uuid4().hex, "published_at": now.isoformat(), "tables": tables}
        # The entry that this one follows may have been compacted away: then its number was taken long ago.
        numbers = entry_numbers(spark, root)
        if (not numbers or number > numbers[0]) and create_entry(spark, root, line):
            compact_log(spark, root)
            return tables


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A published table, empty where it has never been published."""
    folder = current_release(spark, root).get(table)
    schema = SCORE_SCHEMAS.get(table, ALERT_SCHEMA)
    return spark.read.parquet(folder) if folder else spark.createDataFrame([], schema)


def publish_all(
    spark: SparkSession,
    root: str,
    inputs: dict[str, str],
    make_alerts: Callable[[DataFrame, DataFrame, datetime], DataFrame],
    now: datetime | None = None,
) -> DataFrame:
    """Publish every present input and fresh alerts as one release.

    ``inputs`` maps a table name to its parquet path. An absent input is skipped
    with count 0 and keeps its earlier content. Returns ``label, rows``.
    """
    now = now or datetime.now(UTC)
    release = uuid.uuid4().hex
    changed: dict[str, str] = {}
    summary: list[tuple[str, int]] = []
    for table in SCORE_SCHEMAS:
        if table not in inputs or not table_exists(spark, inputs[table]):
            summary.append((table, 0))
            continue
        folder = f"{root}/{table}/{release}"
        stored = stage_scores(spark.read.parquet(inputs[table]), table, folder, now)
        changed[table] = folder
        summary.append((table, stored.count()))

    def alerts(tables: dict[str, str]) -> dict[str, str]:
        def staged(table: str) -> DataFrame:
            if table in tables:
                return spark.read.parquet(tables[table])
            return spark.createDataFrame([], SCORE_SCHEMAS[table])

        folder = f"{root}/alerts/{uuid.uuid4().hex}"
        make_alerts(staged("anomaly_scores"), staged("churn_scores"), now).write.parquet(folder)
        return {"alerts": folder}

    tables = commit_release(spark, root, changed, now, alerts)
    summary.append(("alerts_generated", spark.read.parquet(tables["alerts"]).count()))
    return spark.createDataFrame(summary, "label string, rows bigint").coalesce(1)


BASELINE_TABLE = "churn_score_baseline"


def save_baseline(scores: DataFrame, root: str) -> DataFrame:
    """Store the score distribution (nulls dropped) as the baseline from now on."""
    spark = scores.sparkSession
    folder = f"{root}/{BASELINE_TABLE}/{uuid.uuid4().hex}"
    scores.select("churn_probability").dropna().write.parquet(folder)
    commit_release(spark, root, {BASELINE_TABLE: folder}, datetime.now(UTC))
    return spark.read.parquet(folder)


SKETCH_TABLE = "churn_score_sketch"


def save_sketch(sketch: RankSketch, spark: SparkSession, root: str) -> DataFrame:
    """Store a rank sketch of the scores as the baseline: a table whose size does not depend on the scores."""
    folder = f"{root}/{SKETCH_TABLE}/{uuid.uuid4().hex}"
    sketch.to_frame(spark).write.parquet(folder)
    commit_release(spark, root, {SKETCH_TABLE: folder}, datetime.now(UTC))
    return spark.read.parquet(folder)


def sketch_or_create(scores: DataFrame, root: str, parts: int = PARTS) -> tuple[DataFrame, bool]:
    """The stored sketch, and whether this call had to create it."""
    folder = current_release(scores.sparkSession, root).get(SKETCH_TABLE)
    if folder:
        return scores.sparkSession.read.parquet(folder), False
    return save_sketch(RankSketch.of(scores, "churn_probability", parts), scores.sparkSession, root), True


def baseline_or_create(scores: DataFrame, root: str) -> tuple[DataFrame, bool]:
    """The stored baseline, and whether this call had to create it."""
    folder = current_release(scores.sparkSession, root).get(BASELINE_TABLE)
    if folder:
        return scores.sparkSession.read.parquet(folder), False
    return save_baseline(scores, root), True
