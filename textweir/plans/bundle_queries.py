"""Topics (regions), trends (nations) and signals (orders) of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.operators import bundles
from textweir.plans.corpus import table

REGISTRY = [("event", "^1-URGENT F", 0), ("event", "^2-HIGH O", 1), ("mechanism", "^1-URGENT", 2)]
FLOOR, CEILING = 12, 0.49


def owns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("topic"), F.col("n_nationkey").alias("trend"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("trend"))
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_orderkey").alias("signal"), (F.col("l_linenumber") == 1).alias("canonical"), (F.col("l_returnflag") != "R").alias("supporting"))
    return lines.join(supplier, "l_suppkey").drop("l_suppkey")


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    strength = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 3).when(F.col("o_orderpriority") == "3-MEDIUM", 2).otherwise(1)
    ref = F.concat(F.when(F.pmod("o_custkey", F.lit(5)) == 0, "transcripts/").otherwise("news/"), F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("signal"), F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("claim"), strength.alias("strength"), ref.alias("raw_ref"), (F.col("o_orderstatus") == "O").alias("transcript")
    )


def _owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.owners(signals(spark, sf_dir), bundles.reach(links(spark, sf_dir), owns(spark, sf_dir)), REGISTRY)


def owner_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _owners(spark, sf_dir)


def owner_basis_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _owners(spark, sf_dir).groupBy("basis").agg(F.count(F.lit(1)).alias("n"))


def shared_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = lambda c: F.array_join(F.transform(c, lambda t: t.cast("string")), ",").alias(c)
    return bundles.shared(bundles.reach(links(spark, sf_dir), owns(spark, sf_dir))).select("signal", *map(told, ("topics", "canonical_in", "supporting_in")))


def bundle_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    trends = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("trend"), F.pmod("n_nationkey", F.lit(4)).cast("bigint").alias("first_party"))
    return bundles.stats(owns(spark, sf_dir), trends, links(spark, sf_dir), signals(spark, sf_dir), FLOOR, CEILING)


def source_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    mine = _owners(spark, sf_dir).where(F.col("basis").isin("registry", "mechanism", "lineage")).select("signal", F.col("owner").alias("topic"))
    return bundles.source_pack(mine.join(signals(spark, sf_dir), "signal"), 5, 2)


def ownership_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations' owners with faults put in: a second owner, an unknown trend and topic, and a trend without owner."""
    given = owns(spark, sf_dir).where("trend <> 24").select(F.col("topic").cast("int"), F.col("trend").cast("int"))
    faulty = given.unionByName(spark.sql("SELECT * FROM VALUES (4, 3), (1, 99), (9, 5) AS t(topic, trend)"))
    topics = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("topic"))
    return bundles.violations(faulty, topics, table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("trend")))


QUERIES = {f.__name__: f for f in (owner_resolution, owner_basis_histogram, shared_signals, bundle_stats, source_pack, ownership_violations)}
LINKS_SQL = """
links AS (SELECT l_orderkey AS signal, s_nationkey AS trend, l_linenumber = 1 AS canonical, l_returnflag <> 'R' AS supporting, n_regionkey AS topic
          FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey),
signals AS (SELECT o_orderkey AS signal, o_orderpriority || ' ' || o_orderstatus AS claim, o_orderstatus = 'O' AS transcript,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 3 WHEN o_orderpriority = '3-MEDIUM' THEN 2 ELSE 1 END AS strength,
  (CASE WHEN o_custkey % 5 = 0 THEN 'transcripts/' ELSE 'news/' END) || CAST(o_custkey AS VARCHAR) AS raw_ref FROM orders)
"""
OWNERS_SQL = f"""{LINKS_SQL},
tiers AS (SELECT signal, topic, 1 AS tier FROM links WHERE canonical UNION SELECT signal, topic, 2 FROM links WHERE supporting UNION SELECT signal, topic, 3 FROM links),
grouped AS (SELECT signal, tier, count(*) AS n, string_agg(CAST(topic AS VARCHAR), ',' ORDER BY topic) AS names FROM tiers GROUP BY signal, tier),
first_ AS (SELECT * FROM grouped QUALIFY row_number() OVER (PARTITION BY signal ORDER BY tier) = 1),
owners AS (SELECT s.signal,
  CASE WHEN regexp_matches(claim, '^1-URGENT F') THEN '0' WHEN regexp_matches(claim, '^2-HIGH O') THEN '1' WHEN regexp_matches(claim, '^1-URGENT') THEN '2'
       WHEN n = 1 THEN names WHEN n > 1 THEN 'shared:' || names END AS owner,
  CASE WHEN regexp_matches(claim, '^1-URGENT F|^2-HIGH O') THEN 'registry' WHEN regexp_matches(claim, '^1-URGENT') THEN 'mechanism'
       WHEN n = 1 THEN 'lineage' WHEN n > 1 THEN 'shared' ELSE 'none' END AS basis
  FROM signals AS s LEFT JOIN first_ USING (signal))
"""
ORACLE_SQL = {
    "owner_resolution": f"WITH {OWNERS_SQL} SELECT * FROM owners",
    "owner_basis_histogram": f"WITH {OWNERS_SQL} SELECT basis, count(*) AS n FROM owners GROUP BY basis",
    "shared_signals": f"""WITH {LINKS_SQL}, t AS (SELECT signal, topic, bool_or(canonical) AS c, bool_or(supporting) AS s FROM links GROUP BY signal, topic)
SELECT signal, string_agg(CAST(topic AS VARCHAR), ',' ORDER BY topic) AS topics,
  coalesce(string_agg(CAST(topic AS VARCHAR), ',' ORDER BY topic) FILTER (c), '') AS canonical_in,
  coalesce(string_agg(CAST(topic AS VARCHAR), ',' ORDER BY topic) FILTER (s), '') AS supporting_in FROM t GROUP BY signal HAVING count(*) >= 2""",
    "bundle_stats": f"""WITH {LINKS_SQL},
a AS (SELECT n_regionkey AS topic, count(*) AS owns, CAST(sum(n_nationkey % 4) AS BIGINT) AS fp FROM nation GROUP BY n_regionkey),
b AS (SELECT topic, count(DISTINCT signal) AS signals FROM links GROUP BY topic),
c AS (SELECT topic, avg(CASE WHEN transcript THEN 1.0 ELSE 0.0 END) AS share FROM (SELECT DISTINCT topic, trend, signal FROM links WHERE supporting) JOIN signals USING (signal) GROUP BY topic)
SELECT a.topic, owns, coalesce(signals, 0) AS signals, fp AS first_party_lineages, fp < {FLOOR} AS below_floor, round(coalesce(share, 0.0), 3) AS podcast_share,
  coalesce(share, 0.0) > {CEILING} AS over_podcast_ceiling FROM a LEFT JOIN b ON a.topic = b.topic LEFT JOIN c ON a.topic = c.topic""",
    "source_pack": f"""WITH {OWNERS_SQL},
w AS (SELECT owner AS topic, raw_ref, CAST(sum(strength) AS BIGINT) AS weight, min(signal) AS f, CASE WHEN starts_with(raw_ref, 'transcripts/') THEN 'transcript' ELSE 'article' END AS kind
      FROM owners JOIN signals USING (signal) WHERE basis IN ('registry', 'mechanism', 'lineage') GROUP BY owner, raw_ref),
r AS (SELECT topic, raw_ref, weight, kind, CAST(row_number() OVER (PARTITION BY topic, kind ORDER BY weight DESC, f) AS INTEGER) AS rank FROM w)
SELECT * FROM r WHERE rank <= CASE WHEN kind = 'article' THEN 5 ELSE 2 END""",
    "ownership_violations": """WITH owns AS (SELECT n_regionkey AS topic, n_nationkey AS trend FROM nation WHERE n_nationkey <> 24 UNION ALL SELECT * FROM (VALUES (4, 3), (1, 99), (9, 5)) AS t(topic, trend))
SELECT 'unknown topic' AS rule, CAST(topic AS VARCHAR) AS key FROM owns WHERE topic NOT IN (SELECT r_regionkey FROM region)
UNION SELECT 'unknown trend', CAST(trend AS VARCHAR) FROM owns WHERE trend NOT IN (SELECT n_nationkey FROM nation)
UNION SELECT 'several owners', CAST(trend AS VARCHAR) FROM owns GROUP BY trend HAVING count(*) > 1
UNION SELECT 'no owner', CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_nationkey NOT IN (SELECT trend FROM owns)""",
}
