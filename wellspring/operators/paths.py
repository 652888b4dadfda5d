"""Enumeration of all paths of a graph as a prefix tree on files.

A path is a row of its depth. The row does not hold the whole path but the tables since the last
checkpoint, at most ``SEGMENT`` of them, and the checkpoint's number; rows at a checkpoint hold the
full segment and the number of the checkpoint before. What is written for a path at a depth is thus
bounded, however long the path is, and a path is put together once, when it is complete.

Whether a path comes back to one of its own tables is seen from its segment and, for tables before
the checkpoint, from a filter of 128 bits. Only what the filter cannot clear is looked up in the
checkpoints.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wellspring.session import materialize, work_dir

OPEN, LEAF, CYCLE = "open", "leaf", "cycle"
#: Tables that a row holds at most.
SEGMENT = 16
#: A depth joined with broadcast edges is not shuffled; files of limited length keep it spread out.
ROWS_PER_FILE = 250_000


def _bit(table: Column, seed: int) -> Column:
    """One of 64 bits for a table."""
    place = F.pmod(F.xxhash64(table, F.lit(seed)), F.lit(64)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _bits(segment: Column, seed: int) -> Column:
    """Filter word of all tables of a segment."""
    zero = F.lit(0).cast("long")
    return F.aggregate(segment, zero, lambda word, table: word.bitwiseOR(_bit(table, seed)))


def flagged_edges(edges: DataFrame) -> DataFrame:
    """Distinct edges with ``dep_open``: does the dependency have dependencies itself?"""
    distinct = edges.select("target", "dep").distinct()
    sources = edges.select(F.col("target").alias("dep"), F.lit(True).alias("has_deps")).distinct()
    return distinct.join(sources, "dep", "left").select(
        "target", "dep", F.col("has_deps").isNotNull().alias("dep_open")
    )


def reaching(edges: DataFrame, table: str) -> DataFrame:
    """``table``: all tables from which ``table`` can be reached, itself included.

    A frontier goes backwards over the edges. Each step writes what is new; the last finds nothing.
    """
    spark = edges.sparkSession
    base = work_dir(spark)
    spark.range(1).select(F.lit(table).alias("table")).write.parquet(f"{base}/step=0")
    step = 0
    while True:
        known = spark.read.schema("table string").parquet(*[f"{base}/step={s}" for s in range(step + 1)])
        last = spark.read.schema("table string").parquet(f"{base}/step={step}")
        users = edges.join(last.withColumnRenamed("table", "dep"), "dep", "left_semi")
        new = users.select(F.col("target").alias("table")).distinct().join(known, "table", "left_anti")
        step += 1
        if _written(new, f"{base}/step={step}", F.lit(True)) == [0]:
            return known


def _written(rows: DataFrame, path: str, *counted: Column) -> list[int]:
    """Writes ``rows``; the numbers of those that are ``counted`` come from the write itself."""
    seen = Observation()
    observed = rows.observe(seen, *[F.count_if(c).alias(f"n{i}") for i, c in enumerate(counted)])
    observed.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    return [seen.get.get(f"n{i}") or 0 for i in range(len(counted))]


@dataclass
class Walk:
    """Paths from ``anchors`` (``path``) down to tables without dependencies.

    ``own_from`` is the position from which a path may not repeat a table, and the length of the
    anchors; a path that does so ends there if ``keep_cycles`` is set and is dropped otherwise. With ``through``, only paths that pass
    this table are followed; ``anchors`` must be able to reach it.
    """

    edges: DataFrame
    own_from: int = 1
    keep_cycles: bool = False
    through: str | None = None
    max_depth: int | None = None

    def __post_init__(self) -> None:
        self.spark = self.edges.sparkSession
        self.base = work_dir(self.spark)
        flagged = flagged_edges(self.edges)
        if self.through is not None:
            # tables from which it can be reached
            self.near = reaching(self.edges, self.through).withColumnRenamed("table", "dep")
            flagged = flagged.join(self.near.withColumn("near", F.lit(True)), "dep", "left")
        self.flagged = materialize(flagged)
        self.levels: list[tuple[int, int]] = []  # depth and number of checkpoints before it
        self.longest = 0  # tables in the longest complete path

    def _read(self, depth: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.base}/depth={depth}")

    def _write(self, rows: DataFrame, depth: int, checkpoints: int) -> int:
        self.schema = rows.schema
        self.levels.append((depth, checkpoints))
        is_open = F.col("state") == OPEN
        path = f"{self.base}/depth={depth}"
        open_rows, ended = _written(rows, path, is_open, ~is_open & F.col("passed"))
        if ended:
            self.longest = self.own_from + depth
        return open_rows

    def _passed(self, tables: Column) -> Column:
        return F.lit(True) if self.through is None else F.array_contains(tables, F.lit(self.through))

    def _start(self, anchors: DataFrame) -> DataFrame:
        sources = self.flagged.select(F.col("target").alias("tip"), F.lit(True).alias("more")).distinct()
        path = anchors.select("path", F.element_at("path", -1).alias("tip"))
        own = F.slice("path", self.own_from, F.size("path"))
        return path.join(sources, "tip", "left").select(
            F.monotonically_increasing_id().alias("node"),
            F.lit(None).cast("long").alias("parent"),
            F.col("path").alias("segment"),
            F.lit(0).cast("long").alias("low"),
            F.lit(0).cast("long").alias("high"),
            "tip",
            self._passed(own).alias("passed"),
            F.when(F.col("more"), OPEN).otherwise(LEAF).alias("state"),
        )

    def _own(self, segment: Column, checkpoints: int) -> Column:
        """The part of a segment that may not be repeated."""
        return segment if checkpoints else F.slice(segment, self.own_from, F.size(segment))

    def _step(self, frontier: DataFrame, checkpoints: int, places: list[int]) -> DataFrame:
        """``frontier`` one table further; ``places`` are the depths of the checkpoints before."""
        edges = self.flagged
        rows = frontier.join(edges, F.col("tip") == F.col("target"))
        if self.through is not None:
            rows = rows.where(F.col("passed") | F.col("near"))
        repeats = F.array_contains(self._own(F.col("segment"), checkpoints), F.col("dep"))
        rows = rows.withColumn("repeats", repeats)
        if checkpoints:
            maybe = ~F.col("repeats")
            for word, seed in (("low", 1), ("high", 2)):
                maybe &= F.col(word).bitwiseAND(_bit(F.col("dep"), seed)) != 0
            clear, rest = rows.where(~maybe), rows.where(maybe).withColumn("above", F.col("parent"))
            for number, depth in reversed(list(enumerate(places))):
                before = self._read(depth).select(
                    F.col("node").alias("above"),
                    F.col("parent").alias("next"),
                    self._own(F.col("segment"), number).alias("earlier"),
                )
                again = F.col("repeats") | F.array_contains("earlier", F.col("dep"))
                rest = rest.join(before, "above").withColumn("repeats", again)
                rest = rest.drop("above", "earlier").withColumnRenamed("next", "above")
            rows = clear.unionByName(rest.drop("above"))
        state = F.when(F.col("repeats"), CYCLE).when(F.col("dep_open"), OPEN).otherwise(LEAF)
        passed = F.lit(True) if self.through is None else F.col("passed") | (F.col("dep") == self.through)
        step = rows.select(
            F.monotonically_increasing_id().alias("node"),
            "parent",
            F.array_append("segment", F.col("dep")).alias("segment"),
            "low",
            "high",
            F.col("dep").alias("tip"),
            passed.alias("passed"),
            state.alias("state"),
        )
        return step if self.keep_cycles else step.where(F.col("state") != CYCLE)

    def paths(self, anchors: DataFrame) -> DataFrame:
        """``path, is_cycle``. Every depth is one job, which also tells whether there is another."""
        open_rows = self._write(self._start(anchors), 0, 0)
        depth, checkpoints, held, places = 0, 0, self.own_from, []
        while open_rows:
            if self.max_depth is not None and depth >= self.max_depth:
                raise RuntimeError(f"chains longer than {self.max_depth} steps")
            frontier = self._read(depth).where(F.col("state") == OPEN)
            if held >= SEGMENT:
                own = self._own(F.col("segment"), checkpoints)
                frontier = frontier.select(
                    "node",
                    F.col("node").alias("parent"),
                    F.array().cast("array<string>").alias("segment"),
                    F.col("low").bitwiseOR(_bits(own, 1)).alias("low"),
                    F.col("high").bitwiseOR(_bits(own, 2)).alias("high"),
                    "tip",
                    "passed",
                    "state",
                )
                places, checkpoints, held = [*places, depth], checkpoints + 1, 0
            depth, held = depth + 1, held + 1
            open_rows = self._write(self._step(frontier, checkpoints, places), depth, checkpoints)
        return self._whole(places)

    def _whole(self, places: list[int]) -> DataFrame:
        """Complete paths: segments are put before each other from the last checkpoint to the first."""
        rows = None
        for number in range(len(places), -1, -1):
            depths = [f"{self.base}/depth={d}" for d, n in self.levels if n == number]
            ended = self.spark.read.schema(self.schema).parquet(*depths)
            ended = ended.where((F.col("state") != OPEN) & F.col("passed"))
            ended = ended.select("parent", F.col("segment").alias("path"), "state")
            if rows is not None:
                above = self._read(places[number]).select(
                    F.col("node").alias("parent"), F.col("parent").alias("next"), "segment"
                )
                rows = rows.join(above, "parent").select(
                    F.col("next").alias("parent"), F.concat("segment", "path").alias("path"), "state"
                )
                ended = ended.unionByName(rows)
            rows = ended
        return rows.select("path", (F.col("state") == CYCLE).alias("is_cycle"))
