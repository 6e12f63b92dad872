"""Input views: the job tables as projections of the stored tables.

Every view has a Spark form and the same projection as a SQL common table
expression for the checks.
"""

from pyspark.sql import functions as F

from tallymill.session import scratch_path
from tallymill.streaming.run import file_stream


def table(spark, sf_dir, name):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS tranaction_id",
        "CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE CAST(l_shipdate AS timestamp) END AS tx_datetime",
        "CASE WHEN l_partkey % 53 = 0 THEN -1L ELSE l_partkey END AS customer_id",
        "CASE WHEN l_suppkey % 31 = 0 THEN NULL"
        " ELSE (l_suppkey * 37 + l_linenumber * 101) % 1100 END AS terminal_id",
        "CAST(CASE WHEN l_quantity = 1 THEN 0.0D ELSE l_extendedprice END AS float) AS tx_amount",
        "CAST(timestampdiff(SECOND, timestamp_ntz'1992-01-01', l_shipdate) AS int) AS tx_time_seconds",
        "datediff(l_shipdate, date'1992-01-01') AS tx_time_days",
        "CASE WHEN l_returnflag = 'R' AND l_quantity >= 40 THEN 1 ELSE 0 END AS tx_fraud",
        "CASE WHEN l_returnflag = 'R' AND l_quantity >= 40 THEN 1 + l_linenumber % 3 ELSE 0 END"
        " AS tx_fraud_scenario",
    )


TX = """
tx as (
  select l_orderkey * 10 + l_linenumber as tranaction_id,
         case when l_partkey % 89 = 0 then null else l_shipdate end as tx_datetime,
         case when l_partkey % 53 = 0 then -1 else l_partkey end::bigint as customer_id,
         case when l_suppkey % 31 = 0 then null
              else (l_suppkey * 37 + l_linenumber * 101) % 1100 end::bigint as terminal_id,
         case when l_quantity = 1 then 0.0 else l_extendedprice end::real as tx_amount,
         date_diff('second', timestamp '1992-01-01', l_shipdate)::int as tx_time_seconds,
         date_diff('day', timestamp '1992-01-01', l_shipdate)::int as tx_time_days,
         case when l_returnflag = 'R' and l_quantity >= 40 then 1 else 0 end::int as tx_fraud,
         case when l_returnflag = 'R' and l_quantity >= 40 then 1 + l_linenumber % 3
              else 0 end::int as tx_fraud_scenario
  from lineitem
)"""

TX_ORDER = ("tx_datetime, customer_id, terminal_id, tx_amount, tx_time_seconds, tx_time_days,"
            " tx_fraud, tx_fraud_scenario")

TX_COMPLETE = " and ".join(f"{c} is not null" for c in
                           ["tranaction_id", *TX_ORDER.split(", ")])

# Cleaned rows, copies removed between the amount rule and the id rules.
CLEAN = TX + f""",
survivors as (
  select * from (
    select *, row_number() over (partition by tranaction_id order by {TX_ORDER}) as rn
    from tx where {TX_COMPLETE} and tx_amount > 0) where rn = 1
),
clean as (select * exclude (rn) from survivors where customer_id >= 0 and terminal_id <= 999)"""


def corpus(spark, sf_dir):
    """Documents as collected records; every fifth has no-break spaces after its
    sentences and every fiftieth a stop label."""
    return table(spark, sf_dir, "documents").select(
        F.lit("2024-03-02").cast("timestamp").alias("date"),
        F.when(F.col("doc_id") % 50 == 0, "Гороскоп на сегодня").otherwise(F.col("lang")).alias("zodiac"),
        F.when(F.col("doc_id") % 5 == 0, F.replace("text", F.lit(". "), F.lit(".\u00a0")))
        .otherwise(F.col("text")).alias("horo"),
        "source")


CORPUS = """
corpus as (
  select timestamp '2024-03-02' as date,
         case when doc_id % 50 = 0 then 'Гороскоп на сегодня' else lang end as zodiac,
         case when doc_id % 5 = 0 then replace(text, '. ', '.' || chr(160)) else text end as horo,
         source
  from documents
)"""


def clicks(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(unix_timestamp(CAST(ts AS timestamp)) AS int) AS ts",
        "CAST(user_id AS int) AS user_id",
        "CASE user_id % 3 WHEN 0 THEN 'ru' WHEN 1 THEN 'ua' ELSE 'kz' END AS geo",
        "concat(event_type, event_id % 30 + 1) AS object_id",
        "'example.com' AS domain",
        "concat('https://example.com/', event_type, '/', event_id % 30 + 1) AS url",
        "'https://example.com/' AS url_from",
    )


CLICKS = """
clicks as (
  select floor(epoch(ts))::int as ts, user_id::int as user_id,
         case user_id % 3 when 0 then 'ru' when 1 then 'ua' else 'kz' end as geo,
         event_type || (event_id % 30 + 1) as object_id,
         'example.com' as domain,
         'https://example.com/' || event_type || '/' || (event_id % 30 + 1) as url,
         'https://example.com/' as url_from
  from events
)"""


def predictions(spark, sf_dir):
    """Two models' scores over events; the weight is higher for the rare class."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type",
        "CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label",
        "CASE WHEN event_type = 'purchase' THEN 2.5D ELSE 0.625D END AS weight",
        "value AS score_a", "value + event_id % 7 AS score_b")


PREDICTIONS = """
predictions as (
  select event_id, event_type,
         case when event_type = 'purchase' then 1 else 0 end::int as label,
         case when event_type = 'purchase' then 2.5 else 0.625 end::double as weight,
         value as score_a, value + event_id % 7 as score_b
  from events
)"""


def generations(spark, sf_dir):
    """Labelled documents with embeddings as generated texts of a three-set sweep."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    labels = table(spark, sf_dir, "labels")
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), "embedding")
    return docs.join(labels, "doc_id").join(vectors, "doc_id").selectExpr(
        "'mill' AS model_name",
        "CASE doc_id % 3 WHEN 0 THEN 0.8D WHEN 1 THEN 0.5D ELSE 0.1D END AS top_p",
        "CASE doc_id % 3 WHEN 0 THEN 0.7D WHEN 1 THEN 0.5D ELSE 0.2D END AS temperature",
        "doc_id", "text AS gen_text", "quality AS grm_label", "1 - toxic AS sentiment",
        "n_chars / 1024D AS gen_time", "embedding")


GENERATIONS = """
generations as (
  select 'mill' as model_name,
         case doc_id % 3 when 0 then 0.8 when 1 then 0.5 else 0.1 end::double as top_p,
         case doc_id % 3 when 0 then 0.7 when 1 then 0.5 else 0.2 end::double as temperature,
         doc_id, text as gen_text, quality as grm_label, 1 - toxic as sentiment,
         n_chars / 1024.0::double as gen_time, embedding
  from documents join labels using (doc_id)
       join (select vec_id as doc_id, embedding from embeddings) using (doc_id)
)"""


def listings(spark, sf_dir):
    """Source and target inventories over all orders: the copy lost the objects of
    one priority, damaged some others and holds some under new names."""
    orders = (table(spark, sf_dir, "orders").groupBy("o_orderkey")
              .agg(F.floor(F.max("o_totalprice") * 100).cast("long").alias("size"),
                   F.max(F.col("o_orderdate").cast("timestamp")).alias("modified"),
                   F.max("o_orderpriority").alias("priority")))
    key = F.col("o_orderkey")
    source = orders.select("modified", "size", F.concat(F.lit("p/"), key.cast("string")).alias("key"))
    target = orders.filter("priority <> '5-LOW'").select(
        "modified",
        F.when(key % 17 == 0, F.col("size") + 1).otherwise(F.col("size")).alias("size"),
        F.when(key % 101 == 0, F.concat(F.lit("new-"), key.cast("string")))
        .otherwise(key.cast("string")).alias("key"))
    return source, target


LISTINGS = """
o as (
  select o_orderkey as k, floor(max(o_totalprice) * 100)::bigint as size,
         max(o_orderdate) as modified, max(o_orderpriority) as priority
  from orders group by 1
),
source_listing as (select modified, size, k::varchar as key from o),
target_listing as (
  select modified, case when k % 17 = 0 then size + 1 else size end as size,
         case when k % 101 = 0 then 'new-' || k else k::varchar end as key
  from o where priority <> '5-LOW'
)"""


def one_by_one(spark, batches, name):
    """Rows staged as one file per value of ``batch``, which a file stream reads in that order."""
    staged = scratch_path(spark, name)
    batches.repartition("batch").write.partitionBy("batch").parquet(staged)
    root = spark._jvm.org.apache.hadoop.fs.Path(staged)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in fs.listStatus(root):
        if folder.isDirectory():
            number = int(folder.getPath().getName().removeprefix("batch="))
            for file in fs.listStatus(folder.getPath()):
                fs.setTimes(file.getPath(), 1_700_000_000_000 + 1000 * number, -1)
    return file_stream(spark, f"{staged}/*", batches.drop("batch").schema, max_files=1)
