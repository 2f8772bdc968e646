"""Postings derived from the order tables of the test data.

Four orders in a row are sightings of one posting: the first two fall in run 0
(a duplicate inside the run), the third in run 1, the fourth in run 2. Every
column is a function of the order and its customer, so the volume follows the
tables. The texts below are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import vocabulary as V
from ..functions.text import literal

TITLES = [
    "Senior Data Engineer", "Data Analyst", "Junior Data Analyst", "Lead Analytics Engineer",
    "Data Platform Developer", "Sales Data Analyst", "BI Analyst", "Business Intelligence Consultant",
    "Sr. Data Engineer", "Data Engineer, Internal Tools", "DevOps Engineer", "Data Engineer (SRE team)",
    "Head of Data Analytics", "STAFF DATA ENGINEER", "Graduate Data Analyst", "Data Engineer - Power", None,
]

DESCRIPTIONS = [
    "We use Python and SQL daily", "PostgreSQL, Airflow and dbt; hybrid setup",
    "No remote work. Excel and Power BI", "Work from home. AWS, Snowflake",
    "Excellent communication, not remote", "BI reporting with Tableau, remote",
    "Kafka, Spark and Docker. Fully distributed", "Office-based only, hybrid kitchen",
    "Azure or GCP, MongoDB/NoSQL, MySQL, Talend, Looker ETL", "No tech skills mentioned here",
    "", "Remote PYTHON team", None,
]


RUN_TIMES = ["2026-09-07T06:00:00", "2026-09-14T06:00:00", "2026-09-21T06:00:00"]


def _pick(values: list[str | None], index: str) -> str:
    literals = ", ".join("CAST(NULL AS STRING)" if v is None else literal(v) for v in values)
    return f"element_at(array({literals}), CAST({index} AS INT) + 1)"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """The rows, dealt by ``key`` over all cores if they would be read by fewer tasks than there are cores.

    A file of one row group is read by one task, which would then work out all rules alone."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores, key) if rows.rdd.getNumPartitions() < cores else rows


def order_postings(spark: SparkSession, folder: str) -> DataFrame:
    """Staging-like rows: posting columns, extracted_at, ordinal, run_date."""
    orders = spread(read_table(spark, folder, "orders"), "o_orderkey")
    customers = read_table(spark, folder, "customer")
    nations = read_table(spark, folder, "nation")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    rows = rows.selectExpr(
        "o_orderkey AS n",
        "o_orderkey % 4 AS r",
        "o_orderkey DIV 4 AS p",
        "CAST(o_totalprice AS DECIMAL(12,2)) AS price",
        "o_orderdate", "o_orderstatus", "c_custkey", "c_name", "n_nationkey",
    )
    rows = rows.selectExpr(
        f"IF(p % 4 = 0, '{V.SOURCE_A}', '{V.SOURCE_B}') AS source",
        "CAST(p AS STRING) AS external_id",
        _pick(TITLES, f"(p * 3 + IF(p % 6 = 0, r, 0)) % {len(TITLES)}") + " AS title",
        "CASE c_custkey % 20 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE c_name END AS company_name",
        """CASE WHEN p % 4 = 0 THEN 'Worldwide'
                WHEN p % 5 = 0 THEN concat('City', p % 40, ', Region')
                WHEN p % 5 = 1 THEN concat('  City', p % 40, ' , Region, X')
                WHEN p % 5 = 2 THEN concat('City', p % 8 * 5)
                WHEN p % 5 = 3 THEN ', Region' END AS location""",
        f"""CASE WHEN p % 4 = 0 THEN NULL WHEN n_nationkey = 24 THEN 'us'
                ELSE {_pick(V.SOURCE_B_COUNTRIES, f"n_nationkey % {len(V.SOURCE_B_COUNTRIES)}")} END AS country""",
        """CASE n % 7 WHEN 0 THEN 'None' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '0'
                ELSE CAST(price AS STRING) END AS salary_min""",
        """CASE (n + 3) % 7 WHEN 0 THEN 'None' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN 'negotiable'
                WHEN 4 THEN concat(price, '5') ELSE CAST(price * 2 AS STRING) END AS salary_max""",
        "CASE n % 3 WHEN 0 THEN 'full_time' WHEN 1 THEN 'part_time' END AS job_type",
        "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") AS publication_date",
        _pick(DESCRIPTIONS, f"(p * 5 + r) % {len(DESCRIPTIONS)}") + " AS description",
        "concat('https://jobs.example.org/', p) AS url",
        "IF(p % 4 = 0, array('data', o_orderstatus), CAST(array() AS ARRAY<STRING>)) AS tags",
        f"CASE WHEN r < 2 THEN '{RUN_TIMES[0]}' WHEN r = 2 THEN '{RUN_TIMES[1]}' ELSE '{RUN_TIMES[2]}' END AS extracted_at",
        "n AS ordinal",
    )
    run_date = F.expr("to_date(substring(extracted_at, 1, 10))")
    return rows.withColumns({"work_mode": rules.work_mode(), "run_date": run_date})


# The same rows as the two feeds would have delivered them. Every 101st job
# has lost its id; the place in the feed follows the order number.

def _job_id() -> Column:
    return F.when(F.col("ordinal") % 101 != 0, F.col("external_id"))


def _place(terms: int) -> list[Column]:
    n = F.col("ordinal")
    return [(n % terms).alias("term"), F.call_function("div", n, F.lit(1000)).alias("page"), (n % 1000).alias("pos")]


def source_a_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """``run, term, page, pos, job`` of feed A."""
    rows = order_postings(spark, folder).where(F.col("source") == V.SOURCE_A)
    job = F.struct(
        _job_id().alias("id"),
        "title",
        "company_name",
        F.col("location").alias("candidate_required_location"),
        "job_type",
        "publication_date",
        "description",
        "url",
        "tags",
    )
    return rows.select(F.col("extracted_at").alias("run"), *_place(len(V.SOURCE_A_TERMS)), job.alias("job"))


def source_b_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """``run, country, term, page, pos, job`` of feed B."""
    rows = order_postings(spark, folder).where(F.col("source") == V.SOURCE_B)
    job = F.struct(
        _job_id().alias("id"),
        "title",
        "description",
        F.struct(F.col("company_name").alias("display_name")).alias("company"),
        F.struct(F.col("location").alias("display_name")).alias("location"),
        "salary_min",
        "salary_max",
        F.col("job_type").alias("contract_time"),
        F.col("publication_date").alias("created"),
        F.col("url").alias("redirect_url"),
    )
    return rows.select(
        F.col("extracted_at").alias("run"), "country", *_place(len(V.SOURCE_B_TERMS)), job.alias("job")
    )
