"""The whole corpus run: records in, documents, manifest, metrics and a sample out.

    python -m casemill.plans.corpus --tables FOLDER --out FOLDER [--per-body 50] ...
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.functions import quality
from casemill.functions import text as T
from casemill.operators import cases as cases_of
from casemill.operators import documents, sampling
from casemill.operators.keywords import keywords_of
from casemill.sources import sinks
from casemill.sources.tables import row_digest, table


@dataclass(frozen=True)
class Settings:
    """What a run depends on; checked when it is made."""

    tables: str
    out: str
    min_content: int = 1000
    year: str | None = None
    per_body: int | None = None
    seed: str = "casemill"
    every: int = 1500
    back: int = 100
    generated: str = ""
    #: A folder that all workers share, for one file a document; none are written without it.
    files: str = ""
    fail_on: str = "critical"

    def __post_init__(self) -> None:
        if self.min_content < 100:
            raise ValueError("min_content must be at least 100")
        if self.per_body is not None and self.per_body < 1:
            raise ValueError("per_body must be at least 1")
        if self.fail_on not in ("critical", "any", "never"):
            raise ValueError("fail_on must be critical, any or never")
        if self.every <= self.back:
            raise ValueError("every must be greater than back")


NEEDED = (
    "id", "citation", "publication_date", "language", "content", "metadata_relpath", "pdf_link", "web_link", "source_name", "blob_name",
    "file_stem", "page_count",
)


def _writable(spark: SparkSession, folder: str) -> bool:
    """Whether a file can be made below the folder, on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    probe = jvm.org.apache.hadoop.fs.Path(f"{folder}/_probe")
    try:
        fs = probe.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.create(probe, True).close()
        return bool(fs.delete(probe, False))
    except Exception:
        return False


def preflight(spark: SparkSession, settings: Settings) -> dict[str, bool]:
    """Whether the tables can be read and have what the run needs; each probe stops at its first row."""
    out: dict[str, bool] = {}
    for name in ("case_records", "blobs"):
        try:
            out[f"{name}_readable"] = not table(spark, settings.tables, name).isEmpty()
        except AnalysisException:
            out[f"{name}_readable"] = False
    missing = set(NEEDED) - set(table(spark, settings.tables, "case_records").columns) if out["case_records_readable"] else set(NEEDED)
    out["columns_present"] = not missing
    out["output_writable"] = _writable(spark, settings.out)
    if out["columns_present"]:
        rows = table(spark, settings.tables, "case_records")
        for lang in ("en", "fr"):
            out[f"{lang}_with_content"] = not rows.where((F.lower(F.substring("language", 1, 2)) == lang) & (F.length("content") > 1000)).isEmpty()
    return out


def selected_cases(spark: SparkSession, settings: Settings) -> DataFrame:
    """One row for each record that the run takes, classified and ranked, joined to its blob.

    Of several rows with one id the one with the longest content is taken, of those
    the greatest by a digest of the row.
    """
    c = F.col
    rows = table(spark, settings.tables, "case_records").where(F.length("content") >= settings.min_content)
    if settings.year:
        rows = rows.where(c("publication_date").startswith(settings.year))
    names = table(spark, settings.tables, "blobs").select(c("name").alias("blob_name")).distinct()
    body = T.tribunal_of(c("citation"), c("metadata_relpath"), c("pdf_link"))
    one = cases_of.latest(rows.select("*", *row_digest(rows)), ["id"], F.desc(F.length("content")), F.desc("_row_a"), F.desc("_row_b")).drop("_row_a", "_row_b")
    made = one.join(names, "blob_name", "left_semi").withColumn("tribunal", body).withColumn("tribunal_rank", T.tribunal_rank(c("tribunal")))
    return sampling.stratified(made, ["tribunal"], "id", settings.per_body, settings.seed).drop("rn") if settings.per_body else made


def export_paths(cases: DataFrame) -> DataFrame:
    """(id, rel_path): where the file of each case goes; names that collide get _v2, _v3 and so on in the order of their ids."""
    c = F.col
    lang = F.coalesce(F.lower(F.substring(F.trim("language"), 1, 2)), F.lit("unknown"))
    name = T.export_name(lang, c("tribunal"), c("tribunal_rank"), c("publication_date"), c("citation"), c("file_stem"), c("id"))
    numbered = sampling.numbered(cases.select("id", F.concat_ws("/", lang, "tribunal", name).alias("base")), "base", "id")
    suffix = F.when(c("n") > 1, F.concat(F.lit("_v"), "n")).otherwise("")
    return numbered.select("id", F.concat("base", suffix, F.lit(".ecl.txt")).alias("rel_path"))


def metrics(cases: DataFrame) -> DataFrame:
    """One row: cases, cases by language, the distribution of bodies, and least, greatest and floored mean length."""
    bodies = cases.groupBy("tribunal").count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("tribunal", "count")))).alias("tribunal_distribution"))
    n = F.col("content_length")
    totals = cases.agg(
        F.count(F.lit(1)).alias("total_cases"),
        F.count_if(F.lower(F.substring("language", 1, 2)) == "en").alias("english_cases"),
        F.count_if(F.lower(F.substring("language", 1, 2)) == "fr").alias("french_cases"),
        F.struct(
            F.coalesce(F.min(n), F.lit(0)).alias("min_length"),
            F.coalesce(F.max(n), F.lit(0)).alias("max_length"),
            F.coalesce(F.floor(F.sum(n) / F.count(n)), F.lit(0)).alias("avg_length"),
        ).alias("content_statistics"),
    )
    return totals.withColumn("_k", F.lit(1)).join(bodies.withColumn("_k", F.lit(1)), "_k").drop("_k")


def run(spark: SparkSession, settings: Settings) -> dict[str, int]:
    """Checks, writes all products below ``settings.out``, and returns how many rows each has.

    Documents are made once, with what the manifest needs of them beside; manifest,
    metrics, sample and files are read from that table.
    """
    failed = [k for k, ok in preflight(spark, settings).items() if not ok]
    if failed:
        raise RuntimeError("preflight failed: " + ", ".join(failed))
    cases = selected_cases(spark, settings)
    if settings.fail_on != "never":
        checked = cases.select("id", quality.record_failures(settings.min_content).alias("failed"))
        critical = F.arrays_overlap("failed", F.array(*map(F.lit, ("id", "metadata_relpath", "content"))))
        bad = checked.where(critical if settings.fail_on == "critical" else F.size("failed") > 0).limit(1).collect()
        if bad:
            raise RuntimeError(f"records fail their checks, the first is {bad[0]['id']}")
    c = F.col
    known = cases.withColumn("keywords", keywords_of(c("content"))).withColumn("anchor", T.anchor(c("content")))
    document = documents.text_document(settings.generated, every=settings.every, back=settings.back, keywords=c("keywords"), anchor=c("anchor"))
    made = known.select(
        "id", "citation", "tribunal", "tribunal_rank", "language", "publication_date", "page_count", F.length("content").alias("content_length"),
        T.content_hash(c("content")).alias("content_hash"), "keywords", documents.short_anchor(c("anchor")).alias("anchor"),
        quality.manifest_exceptions(settings.min_content).alias("exceptions"), F.coalesce(F.lower(F.substring(F.trim("language"), 1, 2)), F.lit("unknown")).alias("lang"),
        c("tribunal").alias("body"), document.alias("document"),
    )
    sinks.write_documents(made.join(export_paths(cases), "id"), f"{settings.out}/documents", ["lang", "body"])
    products = spark.read.parquet(f"{settings.out}/documents")
    listed = products.drop("document", "lang", "body")
    sinks.write_manifest(listed, f"{settings.out}/manifest", ["language", "id"])
    sinks.write_metrics(metrics(listed), f"{settings.out}/metrics")
    sample = listed.orderBy(F.col("tribunal") != "scc", "id").limit(1).select("id")
    products.join(F.broadcast(sample), "id").select("id", "document").write.mode("overwrite").parquet(f"{settings.out}/sample")
    if settings.files:
        sinks.export_files(products, settings.files)
    n = listed.count()
    return {"documents": n, "manifest": n}


def preview(spark: SparkSession, settings: Settings, lines: int = 20) -> str:
    """What a run would write for its first case: the header and the first lines of the content."""
    case = selected_cases(spark, settings).orderBy("tribunal_rank", "id").limit(1)
    found = case.select(documents.preview(settings.generated, lines).alias("p")).collect()
    return found[0]["p"] if found else ""


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--tables", required=True)
    args.add_argument("--out", required=True)
    args.add_argument("--min-content", type=int, default=1000)
    args.add_argument("--year")
    args.add_argument("--per-body", type=int)
    args.add_argument("--seed", default="casemill")
    args.add_argument("--every", type=int, default=1500)
    args.add_argument("--back", type=int, default=100)
    args.add_argument("--generated", default="")
    args.add_argument("--files", default="")
    args.add_argument("--dry-run", action="store_true")
    args.add_argument("--fail-on", default="critical")
    given = vars(args.parse_args(argv))
    dry = given.pop("dry_run")
    settings = Settings(**given)
    print((preview if dry else run)(SparkSession.builder.getOrCreate(), settings))


if __name__ == "__main__":
    main()
