"""Queries that score a saved pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.plans.models import logistic_sql
from statloom.plans.profiling import rounded
from statloom.plans.registry import query
from statloom.session import scratch_path
from statloom.sources.tables import SCHEMAS, load_model, save_model, table
from statloom.streaming import scoring
from statloom.streaming.scoring import Field

CONTRACT = [
    Field("c_acctbal", 0.0, 9000.0),
    Field("c_nationkey", 0, 24, 12, "int"),
]
FIELDS = [f.name for f in CONTRACT]


def saved_model(spark, root):
    """Train on the customers that keep the contract, save, and load what was saved."""
    customers = scoring.accepted(table(spark, root, "customer"), CONTRACT).withColumn(
        "label", F.col("c_mktsegment").isin("BUILDING", "MACHINERY").cast("double")
    )
    model = scoring.train_pipeline(customers.select(*FIELDS, "label"), FIELDS, "label")
    return load_model(save_model(model, scratch_path(spark, "model")))


@query(
    "score_rejects",
    "T1",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'c_acctbal: below 0' ELSE 'c_acctbal: above 9000' END AS problems
    FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000
    """,
)
def score_rejects(spark, root):
    bad = scoring.rejects(table(spark, root, "customer"), CONTRACT)
    return bad.select("c_custkey", F.array_join("problems", ";").alias("problems"))


MEDIAN_SQL = """
WITH fit AS (
  SELECT CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS x FROM customer
  WHERE c_custkey % 7 = 0 OR c_acctbal BETWEEN 0 AND 9000
)
SELECT c_custkey, round(CASE WHEN c_custkey % 7 = 0 THEN (SELECT median(x) FROM fit) ELSE c_acctbal END, 4) AS filled
FROM customer WHERE c_custkey % 7 = 0 OR c_acctbal BETWEEN 0 AND 9000
"""


@query("impute_in_pipeline", "C11 L13", MEDIAN_SQL)
def impute_in_pipeline(spark, root):
    """Absent values pass the contract and are filled by the first stage of the saved pipeline."""
    gaps = table(spark, root, "customer").withColumn("c_acctbal", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")))
    rows = scoring.accepted(gaps, CONTRACT).withColumn("label", (F.col("c_nationkey") % 2).cast("double"))
    model = scoring.train_pipeline(rows.select(*FIELDS, "label"), FIELDS, "label")
    loaded = load_model(save_model(model, scratch_path(spark, "model")))
    return rounded(loaded.stages[0].transform(rows).select("c_custkey", F.col("__c_acctbal").alias("filled")), "filled")


SCORE_SQL = f"""
    WITH a AS (SELECT c_custkey, c_acctbal AS f1, c_nationkey::double AS f2, (c_mktsegment IN ('BUILDING', 'MACHINERY'))::int::double AS y
               FROM customer WHERE c_acctbal BETWEEN 0 AND 9000),
    m AS (SELECT avg(f1) AS m1, stddev_pop(f1) AS s1, avg(f2) AS m2, stddev_pop(f2) AS s2 FROM a),
    train AS MATERIALIZED (SELECT c_custkey, y, 1.0::double AS x0, (f1 - m1) / s1 AS x1, (f2 - m2) / s2 AS x2 FROM a, m),
    {logistic_sql(3)},
    p AS (SELECT c_custkey, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM train, w10)
    SELECT c_custkey, round(p, 4) AS p1, printf('%.1f%%', p * 100) AS percent, (p >= 0.5)::int AS predicted,
           CASE WHEN p >= 0.5 THEN 'High risk' ELSE 'Low risk' END AS risk FROM p
"""


@query("score_batch", "T1 S8 L12 L13 F14", SCORE_SQL)
def score_batch(spark, root):
    scored = scoring.score(table(spark, root, "customer"), saved_model(spark, root), CONTRACT, ["c_custkey"])
    return rounded(scored, "p1")


@query("score_stream", "T1 S8", SCORE_SQL)
def score_stream(spark, root):
    """The customers as a file stream; the result is read back from the sink."""
    # A pattern, so that the table may be one file or a folder of files.
    stream = spark.readStream.schema(SCHEMAS["customer"]).parquet(f"{root}/customer.parque[t]")
    output = scratch_path(spark, "scores")
    running = scoring.score_stream(
        stream,
        saved_model(spark, root),
        CONTRACT,
        ["c_custkey"],
        output,
        scratch_path(spark, "rejects"),
        scratch_path(spark, "progress"),
    )
    running.awaitTermination()
    return rounded(spark.read.parquet(output).drop("batch"), "p1")


@query(
    "stream_matches_batch",
    "T1 S8 L12 L13",
    "SELECT count(*) AS accepted, 0::bigint AS only_batch, 0::bigint AS only_stream FROM customer WHERE c_acctbal BETWEEN 0 AND 9000",
)
def stream_matches_batch(spark, root):
    """The same saved model over the customers as a stream of files and as a batch: rows that one of the
    two lacks."""
    batch, stream = score_batch(spark, root), score_stream(spark, root)
    return batch.agg(F.count(F.lit(1)).alias("accepted")).crossJoin(
        batch.exceptAll(stream.select(*batch.columns)).agg(F.count(F.lit(1)).alias("only_batch"))
    ).crossJoin(stream.select(*batch.columns).exceptAll(batch).agg(F.count(F.lit(1)).alias("only_stream")))
