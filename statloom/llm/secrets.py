"""Secret scans over every historical version of a file, with an incremental ledger of blobs.

A blob is a text under the SHA-256 of its content. The ledger records which rule versions have seen
which blob, and what they found. A scan looks only at pairs of blob and rule version that the ledger
lacks, appends them, and joins findings back to all paths that hold the blob.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm.spans import joined, tagged, with_matches
from statloom.session import materialise, scratch_path

LEDGER = "blob string, scanned array<string>, findings array<struct<rule:string,kind:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """A pattern, its version, and for a rule with a condition the group and its least length."""

    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1

    def id(self, kind: str) -> str:
        return f"{kind}@{self.version}"


ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
RULES = {
    "assign": Rule(ASSIGN, group=2, least=12),
    "access": Rule("AKIA[A-Z0-9]{14,}"),
    "hex": Rule("[0-9a-f]{16,}"),
    "pem": Rule(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\x20\x0A\x0D]*"),
    "jwt": Rule(r"\beyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", version=2),
    "provider": Rule(r"\b(?:gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}+|AIza[A-Za-z0-9_-]{35}|[sr]k_live_[A-Za-z0-9]{16,}+)", version=2),
}
BASE = ("assign", "access", "hex")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, empty if nothing was written there yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def unseen(blobs: DataFrame, ledger: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """Blobs with the rule versions in `todo` that the ledger lacks for them."""
    seen = ledger.select("blob", F.explode("scanned").alias("id")).groupBy("blob").agg(F.collect_set("id").alias("seen"))
    current = F.array(*[F.lit(rule.id(kind)) for kind, rule in rules.items()])
    todo = F.array_except(current, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").withColumn("todo", todo).drop("seen").where(F.size("todo") > 0)


def scan(blobs: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """Ledger rows of blobs (`blob`, `text`, `todo`)."""
    found = with_matches(blobs, "text", {k: r.pattern for k, r in rules.items()}, lambda kind: F.array_contains("todo", rules[kind].id(kind)))

    def findings(kind: str, rule: Rule) -> Column:
        spans = F.col(kind)
        if rule.least > 1:
            spans = F.filter(spans, lambda s: F.char_length(F.regexp_extract(s["hit"], rule.pattern, rule.group)) >= rule.least)
        return F.transform(tagged(kind, spans), lambda s: F.struct(F.lit(rule.id(kind)).alias("rule"), *[s[c].alias(c) for c in ("kind", "start", "end")]))

    every = F.concat(*[findings(kind, rule) for kind, rule in rules.items()])
    return found.select("blob", F.col("todo").alias("scanned"), every.alias("findings"))


def scan_versions(
    versions: DataFrame,
    paths: Sequence[str] = ("path", "version"),
    text: str = "text",
    ledger: str | None = None,
    rules: Mapping[str, Rule] = RULES,
) -> DataFrame:
    """One row per input row: the `paths` columns, `blob`, and `findings` of the current rules.

    `ledger` is a folder that later scans go on with; without one a fresh folder below the shared
    folder is used. Null texts are the empty blob. Repeated rows, null paths and copies under many
    paths share one scan and all get its findings; identical texts meet in a partial aggregate before
    the shuffle, and the join back is a plain one that adaptive execution can split. An empty table
    gives no rows. Columns not named are ignored.
    """
    spark = versions.sparkSession
    ledger = ledger or scratch_path(spark, "ledger")
    content = F.coalesce(F.col(text), F.lit(""))
    named = versions.select(F.struct(*paths).alias("at"), F.sha2(content, 256).alias("blob"), content.alias("text"))
    blobs = named.groupBy("blob").agg(F.first("text").alias("text"))
    fresh = unseen(blobs, read_ledger(spark, ledger), rules)
    scan(fresh, rules).write.mode("append").parquet(ledger)
    current = [rule.id(kind) for kind, rule in rules.items()]
    kept = F.filter(F.flatten(F.collect_list("findings")), lambda f: f["rule"].isin(current))
    holding = read_ledger(spark, ledger).where(F.size("findings") > 0).groupBy("blob").agg(kept.alias("findings"))
    holding = materialise(holding, "secret-findings")
    none = F.expr("cast(array() as array<struct<rule:string,kind:string,start:bigint,end:bigint>>)")
    joined_back = named.select("at", "blob").join(holding, "blob", "left")
    return joined_back.select("at.*", "blob", F.coalesce("findings", none).alias("findings"))


def count_of(kind: str) -> Column:
    return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")


def digest(found: DataFrame, rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """Counts and hashes of the base kinds, and all spans as text."""
    base = F.filter("findings", lambda f: f["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *[count_of(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(joined(base, BASE, by_start=True), 256).alias("base_sha256"),
        joined(F.col("findings"), list(rules), by_start=True).alias("spans"),
    )
