"""Secret scans over an incremental ledger of content-addressed texts.

Every version of a text is a blob named by its SHA-256.  The ledger holds the pairs of blob
and rule version that were scanned, and what was found.  A scan reads only blobs that lack a
pair, each once however many paths hold it; findings are joined back to all paths.

Defined cases: a null text is empty; a null path is a path like any other; equal rows share
their findings; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilframe.llm.shared import stored


@dataclass(frozen=True)
class Rule:
    """A match counts if the pattern's ``group`` has ``least`` characters or more.

    Matches are found first, leftmost and without overlap; short ones are dropped after.
    """

    kind: str
    version: int
    pattern: str
    group: int
    least: int


# The three kinds, their patterns and least lengths, in this order.
RULES = (
    Rule(
        "assign",
        1,
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
        r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    # a run of these letters is as long as it gets, so the least length can stand in the pattern
    Rule("access", 1, "AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", 1, "[0-9a-f]{24,}", 0, 24),
)
BLOB, SCANNED, FOUND = "blob string", "blob string, kind string, version int", "blob string, kind string, version int, start long, end long"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


class SecretLedger:
    """A ledger in ``folder``, a place that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}").distinct()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        return self._read("scanned", SCANNED)

    def found(self) -> DataFrame:
        return self._read("found", FOUND)

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Scan what the ledger lacks of ``versions`` (path, text); returns the new pairs.

        Findings are written before the pairs: a run that breaks off in between is scanned
        again, and repeats are removed on reading.
        """
        texts = versions.select("path", F.coalesce("text", F.lit("")).alias("text"), blob_of(F.col("text")).alias("blob"))
        blobs = texts.groupBy("blob").agg(F.min("path").alias("path"))
        kinds = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
        pairs = blobs.select("blob", "path", F.explode(kinds).alias("rule")).select("blob", "path", "rule.*")
        unseen = stored(pairs.join(self.scanned(), ["blob", "kind", "version"], "left_anti"), "unseen")
        wanted = unseen.groupBy("blob", "path").agg(F.collect_set("kind").alias("kinds")).withColumnRenamed("blob", "b")
        wanted = wanted.withColumnRenamed("path", "p")
        one = texts.join(wanted, F.col("path").eqNullSafe(F.col("p")) & (F.col("blob") == F.col("b")))
        _matches(one, rules).write.mode("append").parquet(f"{self.folder}/found")
        unseen.select("blob", "kind", "version").write.mode("append").parquet(f"{self.folder}/scanned")
        return unseen.select("blob", "kind", "version")

    def report(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """One row for each row of ``versions``: path, counts n_KIND, spans (array, by start)."""
        order = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (r.kind, k)])
        current = [f"{r.kind} {r.version}" for r in rules]
        found = self.found().where(F.concat_ws(" ", "kind", "version").isin(current))
        span = F.struct("start", order[F.col("kind")].alias("nth"), "end", "kind")
        by_blob = found.groupBy("blob").agg(
            *[F.count_if(F.col("kind") == r.kind).alias(f"n_{r.kind}") for r in rules],
            F.sort_array(F.collect_list(span)).alias("spans"),  # of one text
        )
        paths = versions.select("path", blob_of(F.col("text")).alias("blob"))
        counts = [F.coalesce(f"n_{r.kind}", F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in rules]
        none = F.array().cast(by_blob.schema["spans"].dataType)
        return paths.join(by_blob, "blob", "left").select("path", "blob", *counts, F.coalesce("spans", none).alias("spans"))


def _matches(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Blob, kind, version and place (code points) of every match in ``texts`` (blob, text, kinds).

    Splitting at the pattern gives the gaps between the matches; places are running sums of
    the lengths, over the rows of one text.
    """
    text = F.col("text")
    by_rule = [
        F.when(
            F.array_contains("kinds", r.kind) & text.rlike(r.pattern),
            F.struct(
                F.lit(r.kind).alias("kind"),
                F.lit(r.version).alias("version"),
                F.arrays_zip(
                    F.transform(F.split(text, r.pattern, -1), F.length).alias("gap"),
                    F.transform(F.regexp_extract_all(text, F.lit(r.pattern), F.lit(0)), F.length).alias("hit"),
                    F.transform(F.regexp_extract_all(text, F.lit(r.pattern), F.lit(r.group)), F.length).alias("size"),
                ).alias("parts"),
            ),
        )
        for r in rules
    ]
    rows = texts.select("blob", F.explode(F.array_compact(F.array(*by_rule))).alias("m"))
    rows = rows.select("blob", "m.kind", "m.version", F.posexplode("m.parts").alias("nth", "part"))
    rows = rows.select("blob", "kind", "version", "nth", "part.*").dropDuplicates(["blob", "kind", "nth"])
    until = F.sum(F.col("gap") + F.col("hit")).over(Window.partitionBy("blob", "kind").orderBy("nth"))
    least = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.least)])
    return (
        rows.where(F.col("hit").isNotNull())
        .withColumn("end", until)
        .where(F.col("size") >= least[F.col("kind")])
        .select("blob", "kind", "version", (F.col("end") - F.col("hit")).alias("start"), "end")
    )


def digest(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
