"""Secret scans over an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger, a Parquet table in a shared folder, has
a row for each pair of blob and rule version that was scanned, with the spans found (often none). A scan reads the contents
of those blobs alone that some rule version has not seen, runs those rules only, appends their rows, and joins the findings
back to all paths. A rule whose version is raised is run anew; blobs known under all rules cost an id each.

Null contents count as empty. Repeated rows and equal contents under many paths are scanned once and reported for each row.
A scan that is cut off leaves the ledger as it was; rows that two scans both append are taken once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewire.functions.once import bind
from tidewire.llm.common import whole_text


@dataclass(frozen=True)
class Rule:
    """A pattern; group and least: the group that must have so many characters, else the match is dropped."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    #: Text without which the pattern can't match, where there is one.
    needs: str | None = None
    base: bool = True

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# A run shorter than the least length never matches in part, so the length stands in the pattern of "access" and "hex";
# "assign" takes any value first, as a dropped match still takes its text.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", needs="AKIA"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", needs="PRIVATE KEY-----", base=False),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needs="eyJ", base=False),
)
_SPANS = "array<struct<start:int,end:int>>"
_LEDGER = f"blob_id string, rule string, spans {_SPANS}"


def running_sums(sizes: Column) -> Column:
    """The sums of an array of integers up to each place, each round adding what lies twice as far back: n log n steps, no array that grows."""
    rounds = F.greatest(F.ceil(F.log2(F.size(sizes))) - 1, F.lit(0)).cast("int")
    add = lambda sums, k: F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - F.call_function("shiftleft", F.lit(1), k)), F.lit(0)))
    return F.when(F.size(sizes) > 0, F.aggregate(F.sequence(F.lit(0), rounds), sizes, add)).otherwise(sizes)


def find_spans(text: Column, rule: Rule) -> Column:
    """Spans of the leftmost matches, in code points: the lengths of what lies between matches add up to the places."""
    none = F.array().cast(_SPANS)

    def walk(found: Column) -> Column:
        between = F.split(text, rule.pattern, -1)
        steps = bind(between, lambda b: F.transform(found, lambda m, i: F.char_length(F.get(b, i)) + F.char_length(m)))
        ends = bind(steps, running_sums)
        spans = bind(ends, lambda e: F.transform(found, lambda m, i: F.struct((F.get(e, i) - F.char_length(m)).alias("start"), F.get(e, i).alias("end"))))
        if rule.least == 1:
            return spans
        sized = found if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
        return bind(sized, lambda s: F.filter(spans, lambda x, i: F.char_length(F.get(s, i)) >= rule.least))

    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    spans = bind(matches, lambda found: F.when(F.size(found) == 0, none).otherwise(walk(found)))
    return F.when(text.contains(rule.needs), spans).otherwise(none) if rule.needs else spans


class SecretLedger:
    """The ledger in one folder."""

    def __init__(self, spark: SparkSession, folder: str, rules: tuple[Rule, ...] = RULES):
        self.spark, self.folder, self.rules = spark, folder.rstrip("/"), rules

    def scanned(self) -> DataFrame:
        """All rows of the ledger, one for each pair of blob and rule version; none yet where the folder is new."""
        try:
            rows = self.spark.read.schema(_LEDGER).parquet(f"{self.folder}/scans")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], _LEDGER)
        return rows.groupBy("blob_id", "rule").agg(F.max("spans").alias("spans"))

    def scan(self, versions: DataFrame, path: str, content: str) -> None:
        """Scan what is unseen among the versions, and append it."""
        rows = versions.select(F.col(path).alias("path"), whole_text(content).alias("text")).withColumn("blob_id", F.sha2("text", 256))
        known = F.array(*(F.lit(r.name) for r in self.rules))
        seen = self.scanned().where(F.col("rule").isin([r.name for r in self.rules])).groupBy("blob_id").agg(F.collect_set("rule").alias("seen"))
        blobs = rows.groupBy("blob_id").agg(F.min("path").alias("first_path")).join(seen, "blob_id", "left")
        todo = blobs.select("blob_id", "first_path", F.array_except(known, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo")).where(F.size("todo") > 0)
        # The path comes first in the key: contents under one path are few, copies of a content may be a third of all rows.
        unseen = rows.join(
            todo.withColumnRenamed("blob_id", "todo_id"),
            F.col("path").eqNullSafe(F.col("first_path")) & (F.col("blob_id") == F.col("todo_id")))
        # What a scan found is packed by blob, so that repeated rows of a path leave one row.
        each = [F.when(F.array_contains("todo", r.name), F.struct(F.lit(r.name).alias("rule"), find_spans(F.col("text"), r).alias("spans"))) for r in self.rules]
        found = unseen.select("blob_id", F.filter(F.array(*each), lambda x: x.isNotNull()).alias("found")).dropDuplicates(["blob_id"])
        found.select("blob_id", F.inline("found")).write.mode("append").parquet(f"{self.folder}/scans")

    def findings(self, versions: DataFrame, path: str, content: str) -> DataFrame:
        """One row per version: path, blob_id, spans of the current rules as (rank, kind, start, end) by place; null if none."""
        rank = F.create_map(*(F.lit(x) for i, r in enumerate(self.rules) for x in (r.name, i)))
        kind = F.create_map(*(F.lit(x) for r in self.rules for x in (r.name, r.kind)))
        hits = self.scanned().where(F.col("rule").isin([r.name for r in self.rules]) & (F.size("spans") > 0))
        packed = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), rank[F.col("rule")].alias("rank"), kind[F.col("rule")].alias("kind"), s["end"].alias("end")))
        by_blob = hits.select("blob_id", packed.alias("spans")).groupBy("blob_id").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
        rows = versions.select(F.col(path).alias("path"), F.sha2(whole_text(content), 256).alias("blob_id"))
        return rows.join(by_blob, "blob_id", "left").select("path", "blob_id", "spans")
