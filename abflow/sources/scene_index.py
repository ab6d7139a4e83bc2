"""File-level scene index of the behaviour log: which files can hold a scene.

The index is a Parquet table with one row per log file: a Bloom filter over the file's scenes
(``BITS`` bits, two hashes), the span of its event times and its line count. A file is known by its name,
size and time of change, so one that is new or was written again counts as unknown and is always read:
the index only leaves out files that cannot hold the scene. ``update`` reads the unknown files alone
and appends their rows; run twice, it adds nothing.

Files are told apart without reading them (a listing as Spark makes one for any scan);
the chosen names go through the driver, as those of every scan do.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.filters import by_scene
from .logs import day_glob, parse_log_lines, valid_rows, with_folder_day

BITS = 32768   # of a file's filter, as many as bitmap_construct_agg has
HASHES = 2
KEY = ["file", "bytes", "modified"]
_DDL = "file string, bytes long, modified timestamp, scenes binary, first_sec long, last_sec long, n_lines long"


def _key() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), F.col("_metadata.file_modification_time").alias("modified")]


def _positions(scene: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(scene, F.lit(k)), F.lit(BITS)) for k in range(HASHES)]


def may_hold(scenes: Column, scene: str) -> Column:
    """Whether the filter has every bit of the scene."""
    out = F.lit(True)
    for p in _positions(F.lit(scene)):
        byte = F.conv(F.hex(F.substring(scenes, (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        out = out & (F.call_function("shiftright", byte, (p % 8).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return out


def _lister(spark: SparkSession) -> SparkSession:
    """A session whose scans have as many tasks as there are cores: a listing reads no content, so
    the files' sizes must not decide."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 50))
    return own


def _files(own: SparkSession, path: str, start: str | None, end: str | None, prefix: str) -> DataFrame:
    """Key and readable path of every file of the day folders; their content isn't read."""
    def read(glob: str) -> DataFrame:
        # signs that a reader would take for a pattern are escaped
        literal = F.regexp_replace("path", r"([\\{}\[\]*?])", r"\\$1")
        return own.read.format("binaryFile").load(glob).select(*_key(), literal.alias("path"))
    try:
        return read(day_glob(path, start, end, prefix))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND" or start is None or end is None:
            raise
        return read(day_glob(path, None, None, prefix)).limit(0)


def _known(own: SparkSession, index_path: str) -> DataFrame:
    try:
        return own.read.schema(_DDL).parquet(index_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return own.createDataFrame([], _DDL)


def update(spark: SparkSession, path: str, index_path: str, start: str | None = None, end: str | None = None, folder_prefix: str = "") -> int:
    """Index the files of the day folders that the index doesn't know; how many there were."""
    own = _lister(spark)
    new = [r.path for r in _files(own, path, start, end, folder_prefix).join(_known(own, index_path), KEY, "left_anti").select("path").collect()]
    if not new:
        return 0
    lines = parse_log_lines(spark.read.text(new).select("value", *_key()), S.F_SCENE + 1)
    # a row per file and scene first, so a large file is never whole in one task
    per = lines.groupBy(*KEY, "scene_id").agg(F.min("action_sec").alias("lo"), F.max("action_sec").alias("hi"), F.count(F.lit(1)).alias("n"))
    bits = F.when(F.col("scene_id").isNotNull(), F.array(*_positions(F.col("scene_id")))).otherwise(F.array(F.lit(None).cast("bigint")))
    rows = per.select(*KEY, "lo", "hi", "n", F.posexplode(bits).alias("k", "bit"))
    rows.groupBy(*KEY).agg(F.bitmap_construct_agg("bit").alias("scenes"), F.min("lo").alias("first_sec"), F.max("hi").alias("last_sec"),
                           F.sum(F.when(F.col("k") == 0, F.col("n")).otherwise(0)).alias("n_lines")).write.mode("append").parquet(index_path)
    return len(new)


def choose(spark: SparkSession, path: str, index_path: str, scene: str, start: str | None = None, end: str | None = None,
           folder_prefix: str = "", seconds: tuple[int, int] | None = None) -> list[str]:
    """Paths of the files that may hold lines of the scene (and, with ``seconds``, of an event time in that
    span), and of those the index doesn't know."""
    own = _lister(spark)
    can = may_hold(F.col("scenes"), scene)
    if seconds:
        can = can & (F.col("first_sec") <= seconds[1]) & (F.col("last_sec") >= seconds[0])
    rows = _files(own, path, start, end, folder_prefix).join(_known(own, index_path), KEY, "left")
    return sorted(r.path for r in rows.filter(F.col("n_lines").isNull() | can).select("path").distinct().collect())


def read_scene_log(spark: SparkSession, path: str, index_path: str, scene: str, start: str | None = None, end: str | None = None,
                   folder_prefix: str = "", min_fields: int = S.LOG_FIELDS, seconds: tuple[int, int] | None = None) -> DataFrame:
    """``by_scene(read_behavior_log(...), scene)`` from the chosen files alone; with ``seconds`` also only
    lines of an event time (epoch seconds) in that span."""
    chosen = choose(spark, path, index_path, scene, start, end, folder_prefix, seconds)
    lines = with_folder_day(spark.read.text(chosen)) if chosen else spark.createDataFrame([], "value string, dt string")
    rows = by_scene(valid_rows(parse_log_lines(lines, min_fields), min_fields)[0], scene)
    return rows.filter(F.col("action_sec").between(*seconds)) if seconds else rows
