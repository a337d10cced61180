"""One query end to end: enrich, scope, consolidate, score, rank, select."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import keys
from ledgerline.operators import counters, joins, latest, scope
from ledgerline.operators.rules import banded, capped_score


def triage_queue(spark: SparkSession, folder: str, top: int = 20) -> DataFrame:
    """The top cases over the given tables: lines are acts, orders processes, parts types, customers holders.

    Cases are grouped by the first key rule that applies; signals are true if any act has them; the order
    is score, latest day, case.
    """
    t = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    acts = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate").withColumnsRenamed({"l_orderkey": "o_orderkey", "l_partkey": "p_partkey"})
    acts = scope.from_day(acts, F.to_date("l_shipdate"), F.lit("1996-01-01").cast("date"))
    acts = scope.without_families(acts, t("part"), "p_partkey", "p_type", ["promo"])
    current = latest.currently_valid(t("orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").cast("string").alias("start"), F.lit("").alias("end")), "o_custkey", "start", "end", "o_orderkey")
    acts = joins.enriched(acts, [(t("part"), "p_partkey", ["p_type", "p_brand"]), (t("orders"), "o_orderkey", ["o_custkey", "o_orderpriority"]), (current.withColumn("open", F.lit(True)), "o_orderkey", ["open"])])
    key = keys.case_key(F.col("o_orderkey"), F.col("p_type"), F.to_date("l_shipdate"), F.col("o_custkey"), F.col("p_brand"), F.col("l_suppkey"), F.lit(None).cast("string"), [("economy", "standard")])
    flags = {"grande": F.col("l_quantity") > 40, "devolvido": F.col("l_returnflag") == "R", "caro": F.col("l_extendedprice") > 60000, "desconto": F.col("l_discount") >= 0.05, "urgente": F.col("o_orderpriority") == "1-URGENT", "vigente": F.coalesce("open", F.lit(False))}
    d = acts.select(key.alias("caso"), F.to_date("l_shipdate").alias("dia"), *[v.alias(k) for k, v in flags.items()])
    case = d.groupBy("caso").agg(*counters.any_flags(list(flags)), F.count("*").alias("atos"), F.max("dia").alias("ultimo_dia"))
    on = {k: F.col(k) for k in flags}
    score = capped_score(on, {"grande": 4, "devolvido": 3, "caro": 3, "urgente": 2, "vigente": 1}, 10, {"desconto": -2}, [], [(on["grande"] & on["devolvido"] & on["caro"], 8)])
    ranked = case.withColumn("score", score).withColumn("faixa", banded(F.col("score"), [(8, "A"), (5, "B"), (2, "C")], "D"))
    return ranked.select("caso", "atos", "ultimo_dia", "score", "faixa").orderBy(F.col("score").desc(), F.col("ultimo_dia").desc(), "caso").limit(top)
