"""Lines that an earlier document holds are dropped; what has been seen lies in levelled sorted runs.

Every batch of documents becomes a bucketed table of its line hashes, sorted by hash. It is merged
with the runs of earlier batches by anti joins, run after run; what no run holds is the batch's own
run, on level 0. As soon as a level has ``FANOUT`` runs, they are merged into one of the next level,
so a line is rewritten once a level and a batch meets few runs. Runs and batches have the same
buckets, so no join moves a run: only the batch's hashes are shuffled, after a map-side combine.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm.tables import stored
from postloom.operators.joins import lookup_join
from postloom.session import shared_dir
from postloom.sinks.tables import write_bucketed

MIN_CODE_POINTS = 10
FANOUT = 2
BATCHES = 4
BLANKS = " \t\n\x0b\x0c\r"
KEYS = ["h", "g"]  # 128 bits: two hashes of a key from different seeds


def _ascii_lower(text: Column) -> Column:
    """A-Z in lower case. Texts of one byte a character take the quick way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def line_keys(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_code_points: int = MIN_CODE_POINTS) -> DataFrame:
    """``(id, version, pos, h, g)`` for every line whose key is long enough; ``version`` tells texts of one id apart."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    key = F.split(_ascii_lower(text), "\n", -1)
    entry = F.transform(
        F.transform(key, lambda line: F.trim(line, F.lit(BLANKS))),
        lambda line, pos: F.struct(
            pos.alias("pos"),
            (F.length(line) >= min_code_points).alias("counts"),
            F.xxhash64(line).alias("h"),
            F.xxhash64(F.lit("line"), line).alias("g"),
        ),
    )
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("version"), F.inline(F.filter(entry, lambda e: e["counts"])))
    return rows.drop("counts")


class LineRuns:
    """The keys of all lines seen so far, as bucketed tables ``<name>_<level>_<number>`` of the catalog.

    The catalog is the only state: another session with the same catalog goes on where this one
    stopped. A batch must be added once.
    """

    def __init__(self, spark: SparkSession, name: str, root: str, fanout: int = FANOUT, buckets: int | None = None) -> None:
        self.spark, self.name, self.root, self.fanout = spark, name, root, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def levels(self) -> dict[int, list[str]]:
        """Names of the runs of each level, oldest first."""
        found: dict[int, list[tuple[int, str]]] = {}
        for row in self.spark.sql(f"SHOW TABLES LIKE '{self.name}_*_*'").collect():
            level, number = row.tableName.rsplit("_", 2)[1:]
            if level.isdigit():
                found.setdefault(int(level), []).append((int(number), row.tableName))
        return {level: [name for _, name in sorted(runs)] for level, runs in sorted(found.items())}

    def _write(self, df: DataFrame, level: int | str, number: int) -> DataFrame:
        name = f"{self.name}_{level}_{number}"
        return write_bucketed(df, name, f"{self.root}/{name}", self.buckets, KEYS)

    def add(self, lines: DataFrame, number: int) -> DataFrame:
        """Take batch ``number`` (ascending) in; the result is ``(h, g, keep)``: keys that lose lines in this batch.

        ``keep`` is the smallest id of the batch if no earlier batch holds the key, else null: then
        all lines with the key go. Lines of a null id count as one document after all others.
        """
        first = lines.groupBy(*KEYS).agg(
            F.min("id").alias("keep"),
            ((F.min("id") < F.max("id")) | (F.bool_or(F.col("id").isNull()) & F.min("id").isNotNull())).alias("shared"),
            F.lit(False).alias("known"),
        )
        batch = self._write(first, "batch", number)
        fresh = batch.select(*KEYS)
        for runs in self.levels().values():
            for run in runs:
                fresh = fresh.join(self.spark.table(run), KEYS, "left_anti")
        own = self._write(fresh, 0, number)
        losing = batch.join(own.withColumn("fresh", F.lit(True)), KEYS, "left").filter("fresh IS NULL OR shared")
        losing = stored(losing.select(*KEYS, F.when(F.col("fresh"), F.col("keep")).alias("keep"), F.col("fresh").isNull().alias("known")), "losing-lines")
        self._drop([f"{self.name}_batch_{number}"])
        self._compact(number)
        return losing

    def _compact(self, number: int) -> None:
        level = 0
        while len(runs := self.levels().get(level, [])) >= self.fanout:
            merged = self.spark.table(runs[0])
            for run in runs[1:]:
                merged = merged.unionAll(self.spark.table(run))
            self._write(merged.repartition(self.buckets, *KEYS), level + 1, number)
            self._drop(runs)
            level += 1

    def _drop(self, runs: list[str]) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run}")

    def close(self) -> None:
        """Take all tables of this store out of the catalog."""
        self._drop([row.tableName for row in self.spark.sql(f"SHOW TABLES LIKE '{self.name}_*'").collect()])


def losing_lines(lines: DataFrame, losing: DataFrame) -> DataFrame:
    """``(id, version, dropped)``: positions of the lines that go, from a batch's lines and its losing keys."""
    hit = lookup_join(lines, losing, KEYS, "inner").filter(F.col("known") | ~F.col("id").eqNullSafe(F.col("keep")))
    return hit.groupBy("id", "version").agg(F.collect_set("pos").alias("dropped"))


def cut_lines(docs: DataFrame, dropped: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_lines, n_dropped, kept)`` for every row of ``docs``; ``kept`` are the other lines, in order."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text")).withColumn("version", F.xxhash64("text"))
    other = dropped.select(F.col("id").alias("_id"), F.col("version").alias("_version"), "dropped")
    rows = rows.join(other, F.col("id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version")), "left")
    rows = rows.select("id", "text", "dropped", F.split("text", "\n", -1).alias("line"))
    staying = F.array_except(F.sequence(F.lit(0), F.size("line") - 1), F.col("dropped"))
    kept = F.array_join(F.transform(staying, lambda pos: F.get(F.col("line"), pos)), "\n")
    return rows.select(
        "id",
        F.size("line").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("kept"),
    )


def dedupe_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_code_points: int = MIN_CODE_POINTS,
    batches: int = BATCHES,
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_lines``, ``n_dropped`` and the ``kept`` text.

    The documents go through the runs in ``batches`` of ascending ids (a number), so of a key held by
    several documents the one with the smallest id keeps all its lines. A null or empty text is one
    empty line. Rows that repeat an id are one document; rows without an id are one document after
    all others. Lines that are short stay. Keys compare without blanks at both ends and without the
    case of A-Z. If all lines go, ``kept`` is empty. An empty table gives an empty result; other
    columns are not read.
    """
    spark = docs.sparkSession
    shares = F.percentile_approx(id_column, [i / batches for i in range(1, batches + 1)])
    borders = sorted(set(docs.agg(shares).head()[0] or []))[:-1]
    later = sum((F.when(F.col("id") > F.lit(border), 1).otherwise(0) for border in borders), F.lit(0))
    root = shared_dir(spark, "llm-lines")
    lines = line_keys(docs, id_column, text_column, min_code_points)
    lines = lines.withColumn("batch", F.when(F.col("id").isNull(), F.lit(len(borders))).otherwise(later))
    lines.write.partitionBy("batch").parquet(f"{root}/lines")
    lines = spark.read.schema(lines.schema).parquet(f"{root}/lines")
    runs = LineRuns(spark, f"line_runs_{uuid.uuid4().hex}", f"{root}/runs")
    dropped = []
    for number in range(len(borders) + 1):
        batch = lines.filter(F.col("batch") == number)
        dropped.append(losing_lines(batch, runs.add(batch, number)))
    runs.close()
    return cut_lines(docs, stored(reduce(DataFrame.unionAll, dropped), "dropped-lines"), id_column, text_column)
