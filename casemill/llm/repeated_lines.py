"""Lines that recur in many records of one site.

The state is tables in a shared folder: how many records of a site hold a line, how
many records a site has, which lines are excessive, and where they stand.  New records
come in as deltas: they are counted apart and merged into the counts, the lines that
cross the threshold in either direction are found, and of the records that were there
before only those that hold such a line are built again.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.session import ensure_checkpoint_dir
from casemill.sources.tables import row_digest

MIN_LETTERS, MIN_RECORDS, MIN_SHARE = 25, 3, 0.03
#: The most lines that are sent to every worker; more are joined by salted keys, as the lines looked for are the hottest keys there are.
MAX_SENT, SALTS = 1_000_000, 16


class LineState(NamedTuple):
    """counts: (site, a, b, n); sizes: (site, n_site). a and b are a line's key."""

    counts: DataFrame
    sizes: DataFrame


def line_key(line: Column, min_letters: int = MIN_LETTERS) -> Column:
    """A 128-bit key of the line's letters in lower case; NULL with fewer than ``min_letters``."""
    letters = F.regexp_replace(F.lower(line), r"[^\p{L}]+", "")
    # most lines that don't count are short as a whole: those never see the pattern
    return F.when(
        F.length(line) >= min_letters,
        F.when(
            F.length(letters) >= min_letters,
            F.struct(F.xxhash64(letters).alias("a"), F.xxhash64(F.lit(1), letters).alias("b")),
        ),
    )


def keyed_records(rows: DataFrame, site: Column, delta: Column | None = None, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(id, record, site, keys): the distinct rows with the key of each line, NULL for a line too short.

    ``record`` is a 128-bit digest of the whole row. Rows are told apart by it, so that
    the keys, a tenth of the text, are shuffled in the place of the text. With
    ``delta`` the delta that a row belongs to is a further column.
    """
    a, b = row_digest(rows)
    digest = F.struct(a.alias("a"), b.alias("b"))
    keys = F.transform(F.split("content", "\n"), lambda x: line_key(x, min_letters))
    of = [] if delta is None else [delta.alias("delta")]
    return rows.select("id", digest.alias("record"), site.alias("site"), keys.alias("keys"), *of).distinct()


def line_state(keyed: DataFrame) -> LineState:
    """The state of these records alone, which is also a delta's.

    A record counts once for a line however often it holds it; records without
    content count for their site.
    """
    counts = (
        keyed.select("site", F.explode(F.array_distinct(F.array_compact("keys"))).alias("k"))
        .groupBy("site", "k.a", "k.b")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return LineState(counts, keyed.groupBy("site").agg(F.count(F.lit(1)).alias("n_site")))


def merge_state(old: LineState, delta: LineState) -> LineState:
    """The state of old and new records together."""
    return LineState(
        old.counts.unionByName(delta.counts).groupBy("site", "a", "b").agg(F.sum("n").alias("n")),
        old.sizes.unionByName(delta.sizes).groupBy("site").agg(F.sum("n_site").alias("n_site")),
    )


def excessive(state: LineState, min_records: int = MIN_RECORDS, min_share: float = MIN_SHARE) -> DataFrame:
    """(site, a, b): the lines in at least ``min_records`` and ``min_share`` of a site's records.

    A site has at most lines-per-record / ``min_share`` of them, whatever its size.
    """
    return (
        state.counts.where(F.col("n") >= min_records)
        .join(state.sizes, "site")
        .where(F.col("n") >= F.round(F.col("n_site") * F.lit(min_share), 9))
        .select("site", "a", "b")
    )


def crossings(before: DataFrame, after: DataFrame) -> DataFrame:
    """(site, a, b, is_excessive): the lines whose side of the threshold changed."""
    key = ["site", "a", "b"]
    return (
        after.join(before, key, "left_anti")
        .withColumn("is_excessive", F.lit(True))
        .unionByName(before.join(after, key, "left_anti").withColumn("is_excessive", F.lit(False)))
    )


def lines_in(keyed: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, record, line_no): where the ``lines`` (site, a, b) stand in the records; numbers count from 1."""
    placed = keyed.select("id", "record", "site", F.posexplode("keys").alias("pos", "k")).where("k IS NOT NULL")
    placed = placed.select("id", "record", "site", (F.col("pos") + 1).alias("line_no"), "k.a", "k.b")
    key = ["site", "a", "b"]
    if lines.limit(MAX_SENT + 1).count() <= MAX_SENT:
        return placed.join(F.broadcast(lines.select(*key)), key, "left_semi").select("id", "record", "line_no")
    salted = lines.select(*key, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    placed = placed.withColumn("_salt", F.pmod(F.xxhash64("record", "line_no"), F.lit(SALTS)).cast("int"))
    return placed.join(salted, [*key, "_salt"], "left_semi").select("id", "record", "line_no")


def without_lines(rows: DataFrame, found: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """The distinct ``rows`` with content free of the lines ``found`` in them (record, line_no).

    With ``only`` (record), those records alone. Rows without such a line and without content stay as they are; of a row of such
    lines only, the empty text is left.
    """
    a, b = row_digest(rows)
    digest = F.struct(a.alias("a"), b.alias("b"))
    drop = found.groupBy("record").agg(F.collect_set("line_no").alias("drop"))
    # the row is carried as one column, so that none of its names can clash
    whole = rows.select(F.struct(*rows.columns).alias("_row"), digest.alias("record"))
    if only is not None:
        whole = whole.join(only, "record", "left_semi")
    whole = whole.dropDuplicates(["record"]).join(drop, "record", "left")
    kept = F.filter(
        F.transform(F.split("_row.content", "\n"), lambda x, i: F.struct(x.alias("x"), (i + 1).alias("i"))),
        lambda p: ~F.array_contains("drop", p["i"]),
    )
    cleaned = F.array_join(F.transform(kept, lambda p: p["x"]), "\n")
    content = F.when(F.col("drop").isNull(), F.col("_row.content")).otherwise(cleaned)
    return whole.select(*((content if c == "content" else F.col("_row")[c]).alias(c) for c in rows.columns))


class LineTables:
    """The state of a corpus in a folder that all workers share, kept up to date delta by delta.

    Below the folder are, for each version n: keyed/n, the records that came with it;
    counts/n, sizes/n and lines/n, the state after it; stale/n, the older records that
    were built again; found/n, where lines stand in the records built with it. A
    version is complete when it has its found/n, and a delta that runs again writes its
    own version anew.
    """

    def __init__(self, spark: SparkSession, folder: str, versions: int = 0):
        self.spark, self.folder, self.versions = spark, folder, versions
        self._schemas: dict = {}

    @classmethod
    def new(cls, spark: SparkSession) -> LineTables:
        """Tables in a new folder below the cluster's shared checkpoint folder."""
        ensure_checkpoint_dir(spark)
        return cls(spark, f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/lines-{uuid.uuid4().hex}")

    def _write(self, name: str, rows: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}/{self.versions + 1}"
        rows.write.mode("overwrite").parquet(path)
        self._schemas[name] = rows.schema
        return self._read(name, self.versions + 1)

    def _read(self, name: str, version: int) -> DataFrame:
        reader = self.spark.read
        if name in self._schemas:
            reader = reader.schema(self._schemas[name])
        return reader.parquet(f"{self.folder}/{name}/{version}")

    def _all(self, name: str) -> DataFrame | None:
        """All versions of a table so far, with the version."""
        out = None
        for n in range(1, self.versions + 1):
            own = self._read(name, n).withColumn("version", F.lit(n))
            out = own if out is None else out.unionByName(own)
        return out

    def _last(self, name: str) -> DataFrame:
        return self._read(name, self.versions)

    def add(self, keyed: DataFrame, min_records: int = MIN_RECORDS, min_share: float = MIN_SHARE) -> None:
        """Merges a delta of keyed records. Records that came before, whole rows alike, don't count again."""
        old = self._all("keyed")
        if old is not None:
            keyed = keyed.join(old.select("record"), "record", "left_anti").select(*keyed.columns)
        new = self._write("keyed", keyed)
        state = line_state(new)
        if old is not None:
            state = merge_state(LineState(self._last("counts"), self._last("sizes")), state)
        state = LineState(self._write("counts", state.counts), self._write("sizes", state.sizes))
        now = self._write("lines", excessive(state, min_records, min_share))
        build = new
        if old is not None:
            changed = crossings(self._last("lines"), now)
            old = old.drop("version")
            stale = self._write("stale", lines_in(old, changed).select("record").distinct())
            build = new.unionByName(old.join(stale, "record", "left_semi").select(*new.columns))
        else:
            self._write("stale", new.select("record").limit(0))
        self._write("found", lines_in(build, now))
        self.versions += 1

    def found(self) -> DataFrame:
        """(id, record, line_no): where excessive lines stand in all records so far, as last built."""
        rows, stale = self._all("found"), self._all("stale")
        last = stale.groupBy("record").agg(F.max("version").alias("built"))
        return rows.join(last, "record", "left").where("version >= coalesce(built, 0)").select("id", "record", "line_no")

    def rebuilt(self) -> DataFrame:
        """(record): the older records that the last delta made to be built again."""
        return self._last("stale")
