"""Every operator as a named query over the test tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerscope.functions import columns as C
from tellerscope.operators import analytics, baseline_store, cdc, live, medallion, ml, profile, risk
from tellerscope.plans import pipeline
from tellerscope.plans.bank_tables import Bank, scored_from
from tellerscope.schemas import BRONZE
from tellerscope.session import work_dir
from tellerscope.sources import files, folders, messages, snapshots, tables
from tellerscope.streaming import jobs, progress

# Fixed points in time instead of the current time.
ANCHOR = "2024-01-01 00:00:00"
SPLIT, DELAY = "2024-01-20 12:00:00", "1 hour"
AS_OF = "2024-01-31 00:00:00"
SINCE = "2024-01-20 12:00:00"
RECENT_MINUTES = 600
EMAIL = "c7@example.org"
FOUND_ID, LIVE_ID, DELETED_ID = "10", "15", "11"
NEW_ROW_IDS = ("4", "5", "12", "13", "14", "15")  # ids of all files
FIRST_FILES = ("part-0.csv", "part-1.csv")
FIRST_TYPES = ("TRANSFER", "CASH_OUT")

QUERIES: dict[str, Callable[[Bank], DataFrame]] = {}


def query(fn: Callable[[Bank], DataFrame]) -> Callable[[Bank], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def simple(name: str, fn: Callable[[Bank], DataFrame]) -> None:
    QUERIES[name] = fn


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(Bank(spark, sf_dir))

    return {name: bind(fn) for name, fn in QUERIES.items()}


def _ntz(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock time, the form the parquet tables use."""
    return df.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"}
    )


def _fine(df: DataFrame) -> DataFrame:
    """Amounts with more decimals than the test tables have."""
    return df.withColumn("amount", F.col("amount") * F.lit(1.00037))


def _rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles without their last digits, which engines print differently."""
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})


def _plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, for comparison with other engines."""
    return df.withColumns(
        {c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")}
    )


# --- sources and sinks ------------------------------------------------------


def _landed(b: Bank, only: tuple[str, ...] | None = None) -> str:
    """Bronze as text files in the shared work folder, the form it arrives in."""
    rows = b.bronze.filter(F.col("source_file").isin(*only)) if only else b.bronze
    path = work_dir(b.spark, "landing")
    files.export_csv(rows.select(*[F.col(c).cast("string") for c in BRONZE.fieldNames()]), path)
    return path


def _typed(bronze: DataFrame) -> DataFrame:
    return C.cast_balances(bronze).withColumns(
        {"amount": C.to_double("amount"), "step": F.col("step").cast("int")}
    )


@query
def ingest_files(b: Bank) -> DataFrame:
    landing, target = _landed(b), work_dir(b.spark, "bronze")
    for _ in range(2):  # the second run finds nothing new
        files.ingest_files(b.spark, landing, BRONZE, target, f"{target}-checkpoint")
    loaded = b.spark.read.parquet(target)
    return _typed(loaded).select(*BRONZE.fieldNames())


@query
def ingest_provenance(b: Bank) -> DataFrame:
    return files.with_provenance(b.table("orders")).select(
        "o_orderkey",
        F.col("source_file").contains("orders.parquet").alias("has_file"),
        F.col("processing_time").isNotNull().alias("has_time"),
    )


@query
def ingest_fraud_reports(b: Bank) -> DataFrame:
    path, target = work_dir(b.spark, "reports"), work_dir(b.spark, "fraud_reports")
    files.export_csv(b.reports, path)
    files.ingest_files(
        b.spark, path, b.reports.schema, target, f"{target}-checkpoint",
        columns=["id", "is_fraud", "source_file"],
    )
    return b.spark.read.parquet(target).select("id", "is_fraud")


@query
def ingest_include_existing(b: Bank) -> DataFrame:
    """Files there before the first start are skipped, later ones are taken."""
    landing, target = _landed(b, FIRST_FILES), work_dir(b.spark, "bronze")
    for part in (None, ("part-2.csv",), ("part-3.csv",)):
        if part:
            rows = b.bronze.filter(F.col("source_file").isin(*part))
            texts = rows.select(*[F.col(c).cast("string") for c in BRONZE.fieldNames()])
            texts.write.mode("append").option("header", True).csv(landing)
        files.ingest_files(
            b.spark, landing, BRONZE, target, f"{target}-checkpoint", include_existing=False
        )
    return _typed(b.spark.read.parquet(target)).select("id", "type", "amount")


@query
def ingest_infer_types(b: Bank) -> DataFrame:
    landing, target = _landed(b), work_dir(b.spark, "bronze")
    schema = files.infer_schema(b.spark, landing)
    files.ingest_files(b.spark, landing, schema, target, f"{target}-checkpoint")
    loaded = b.spark.read.parquet(target)
    return loaded.select(F.col("id").cast("bigint").alias("id"), "step", "amount", "oldBalanceOrig")


def _new_table(b: Bank, purpose: str) -> tuple[str, str]:
    """A free table name and a folder in the shared work folder for its data."""
    location = work_dir(b.spark, purpose)
    return location.rsplit("/", 1)[-1].replace("-", "_"), location


def _stored(b: Bank, table: str, location: str) -> DataFrame:
    """Rows of an external table, which stay readable when the name is dropped."""
    tables.drop_pipeline(b.spark, tables=[table])
    return b.spark.read.parquet(location)


@query
def load_static(b: Bank) -> DataFrame:
    path = work_dir(b.spark, "customers")
    b.customers.write.json(path)
    table, location = _new_table(b, "static")
    loaded = [files.load_static(b.spark, path, table, "json", location=location) for _ in range(2)]
    rows = _stored(b, table, location)
    return rows.select(
        "id", "email", "country", F.lit(loaded[0]).alias("first"), F.lit(loaded[1]).alias("second")
    )


@query
def replace_static(b: Bank) -> DataFrame:
    path = work_dir(b.spark, "countries")
    files.export_csv(b.countries, path)
    table, location = _new_table(b, "static")
    for _ in range(2):
        files.replace_static(b.spark, path, table, location=location)
    return _stored(b, table, location)


@query
def read_headerless(b: Bank) -> DataFrame:
    path = work_dir(b.spark, "headerless")
    b.reports.write.csv(path)
    rows = files.read_files(b.spark, path, header=False)
    return rows.select(F.col("_c0").cast("bigint").alias("_c0"), "_c1")


@query
def rescue_bad_rows(b: Bank) -> DataFrame:
    """Every row of one type is cut short; its text is kept beside what could be read."""
    path = work_dir(b.spark, "ragged")
    whole = F.concat_ws(",", "id", "type", F.col("step").cast("string"), "customer_id")
    cut = F.concat_ws(",", "id", "type")
    line = F.when(F.col("type") == "DEBIT", cut).otherwise(whole)
    b.bronze.select(line.alias("value")).write.text(path)
    schema = T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("type", T.StringType()),
            T.StructField("step", T.IntegerType()),
            T.StructField("customer_id", T.StringType()),
        ]
    )
    # Kept once: Spark cannot answer from the rescued column alone.
    return files.read_with_rescue(b.spark, path, schema, header=False).withColumnRenamed(
        files.RESCUED, "rescued"
    )


@query
def pull_columns_overwrite(b: Bank) -> DataFrame:
    path = work_dir(b.spark, "reports")
    files.export_csv(b.reports.withColumn("unused", F.lit("x")), path)
    table, location = _new_table(b, "pulled")
    for _ in range(2):
        files.pull_csv(b.spark, path, table, ["is_fraud", "id"], location=location)
    return _stored(b, table, location).withColumn("id", F.col("id").cast("bigint"))


@query
def csv_single_file(b: Bank) -> DataFrame:
    path = work_dir(b.spark, "export")
    files.export_csv(profile.type_frequencies(b.gold), path, single=True)
    rows = files.read_files(b.spark, path)
    parts = rows.select(F.col("_metadata.file_path")).distinct().count()
    return rows.select(
        "type", F.col("count").cast("bigint").alias("count"), F.lit(parts).alias("parts")
    )


@query
def drop_objects(b: Bank) -> DataFrame:
    table, location = _new_table(b, "silver")
    b.silver.write.option("path", location).saveAsTable(table)
    b.gold.createOrReplaceTempView(f"{table}_gold")
    names = {"table": table, "view": f"{table}_gold"}
    before = {kind: b.spark.catalog.tableExists(name) for kind, name in names.items()}
    for _ in range(2):  # dropping what is not there is no error
        tables.drop_pipeline(b.spark, [table], [f"{table}_gold"])
    after = {kind: b.spark.catalog.tableExists(name) for kind, name in names.items()}
    return b.spark.createDataFrame(
        [(kind, before[kind], after[kind]) for kind in names],
        "kind string, before boolean, after boolean",
    )


@query
def reset_scored(b: Bank) -> DataFrame:
    target = work_dir(b.spark, "scored")
    tables.insert_if_absent(b.scored, target, 0)
    before = tables.read_scored(b.spark, target).count()
    tables.reset(b.spark, target)
    left = tables.read_scored(b.spark, target)
    return left.agg(F.count(F.lit(1)).alias("rows_left")).withColumn("rows_before", F.lit(before).cast("bigint"))


@query
def parse_json_messages(b: Bank) -> DataFrame:
    k = F.col("k")
    text = F.to_json(
        F.struct(
            F.when(k % 17 != 0, k).alias("id"),
            F.lit(ANCHOR).alias("timestamp"),
            "type",
            "amount",
            F.col("o_custkey").alias("customer_id"),
            F.concat(F.lit("First "), "o_custkey").alias("firstname"),
            F.when(k % 3 == 0, F.concat(F.lit('"Last", '), "o_custkey")).alias("lastname"),
            F.concat(F.lit("N"), "c_nationkey").alias("country_orig"),
            F.concat(F.lit("N"), k % 25).alias("country_dest"),
            F.col("oldBalanceOrig").alias("old_balance_orig"),
            (F.col("oldBalanceOrig") - F.col("amount")).alias("new_balance_orig"),
            F.col("oldBalanceDest").alias("old_balance_dest"),
            F.when(k % 5 != 0, F.col("oldBalanceDest") + F.col("amount")).alias("new_balance_dest"),
            (-F.col("amount")).alias("diff_orig"),
            F.col("amount").alias("diff_dest"),
            F.lit("x").alias("extra"),
        )
    )
    broken = F.when(k % 13 == 0, F.concat(F.lit("{"), text)).otherwise(text)
    return messages.parse_messages(b.txn_base.select(broken.cast("binary").alias("value")))


@query
def rejected_messages(b: Bank) -> DataFrame:
    """Messages by the reason for which they are set aside."""
    k = F.col("k")
    text = F.to_json(
        F.struct(
            F.when(k % 17 != 0, k).alias("id"),
            F.when(k % 19 == 0, "not a time").otherwise(ANCHOR).alias("timestamp"),
            "type",
        )
    )
    broken = F.when(k % 13 == 0, F.concat(F.lit("{"), text)).otherwise(text)
    found = messages.rejected(b.txn_base.select(broken.cast("binary").alias("value")))
    return analytics.counts_by(found, "reason")


@query
def insert_if_absent(b: Bank) -> DataFrame:
    target = work_dir(b.spark, "scored")
    early = b.scored.filter(F.col("type").isin(*FIRST_TYPES))
    late_copy = early.withColumns(
        {
            "amount": F.col("amount") + 1,
            "timestamp": F.col("timestamp") + F.make_dt_interval(hours=F.lit(1)),
        }
    )
    second = b.scored.withColumn("amount", F.col("amount") + 2)
    tables.insert_if_absent(early.unionByName(late_copy), target, 0)
    for _ in range(2):  # a retried batch changes nothing
        tables.insert_if_absent(second, target, 1)
    return tables.read_scored(b.spark, target).select("id", "type", "amount")


@query
def insert_indexed(b: Bank) -> DataFrame:
    """As ``insert_if_absent``, through the index of keys; the first rows were stored without one."""
    target = work_dir(b.spark, "scored")
    part = lambda n: b.scored.filter(F.col("id") % 3 == n)
    tables.insert_if_absent(part(0), target, 0, run="old")
    for batch in (0, 1, 1):  # a retried batch changes nothing
        again = b.scored.filter(F.col("id") % 3 <= batch + 1)
        later = F.col("timestamp") + F.make_dt_interval(hours=F.lit(1))
        copies = again.withColumns({"amount": F.col("amount") + 1, "timestamp": later})
        tables.insert_indexed(part(batch + 1).unionByName(copies), target, batch, run="new", buckets=16)
    return tables.read_scored(b.spark, target).select("id", "type", "amount")


@query
def merge_insert_only(b: Bank) -> DataFrame:
    target = work_dir(b.spark, "silver")
    first = b.silver.filter(F.col("source_file").isin(*FIRST_FILES))
    unlabelled = first.withColumn("is_fraud", F.lit(None).cast("int"))
    tables.merge_insert_only(unlabelled, target)
    for _ in range(2):  # labels that came late, and repeated rows, change nothing
        tables.merge_insert_only(b.silver, target)
    return b.spark.read.parquet(target)


@query
def merge_into_bucketed(b: Bank) -> DataFrame:
    table, location = _new_table(b, "silver")
    first = b.silver.filter(F.col("source_file").isin(*FIRST_FILES))
    tables.merge_into_bucketed(first.withColumn("is_fraud", F.lit(None).cast("int")), table, buckets=8, location=location)
    for _ in range(2):
        tables.merge_into_bucketed(b.silver, table)
    return _stored(b, table, location)


@query
def relabel_late_reports(b: Bank) -> DataFrame:
    unlabelled = b.silver.select(
        "id",
        "amount",
        F.when(~F.col("source_file").isin(*FIRST_FILES), F.col("is_fraud")).alias("is_fraud"),
    )
    return tables.relabel(unlabelled, b.reports)


simple("customer_lookup", lambda b: profile.customer_lookup(
    b.customers.withColumn("country", F.nullif(F.col("country"), F.lit("N03")))
))


@query
def profile_json_sink(b: Bank) -> DataFrame:
    """All sections read back from JSON, one row per figure."""
    path = work_dir(b.spark, "profile")
    profile.write_profile(b.gold, path, profiled_at=datetime.fromisoformat(f"{ANCHOR}+00:00"), exact=True)
    keys = {
        "overall": (),
        "type_frequencies": ("type",),
        "country_pairs": ("countryOrig_name", "countryDest_name"),
        "numeric_profiles": ("type", "is_fraud"),
    }
    out = b.spark.read.json(f"{path}/metadata").select(
        F.lit("metadata").alias("section"), F.lit("").alias("key"), F.lit("profiled_at").alias("figure"),
        F.unix_seconds(F.col("profiled_at").cast("timestamp")).cast("double").alias("value"),
    )
    for section, own in keys.items():
        rows = b.spark.read.json(f"{path}/{section}")
        figures = [c for c in rows.columns if c not in own]
        pairs = F.array(*[F.struct(F.lit(c).alias("figure"), F.round(F.col(c).cast("double"), 3).alias("value")) for c in figures])
        out = out.unionByName(rows.select(
            F.lit(section).alias("section"), F.concat_ws("/", *[F.col(c).cast("string") for c in own]).alias("key"), F.inline(pairs)
        ))
    return out


# --- projections, filters, row rules ----------------------------------------

simple("clean_country", lambda b: C.clean_countries(b.bronze).select("id", "countryOrig", "countryDest"))
simple("cast_balances", lambda b: C.cast_balances(
    b.bronze.withColumns({c: F.col(c).cast("string") for c in C.BALANCES})
).select("id", *C.BALANCES))
simple("balance_deltas", lambda b: C.balance_deltas(b.bronze).select("id", "diffOrig", "diffDest"))
simple("star_except", lambda b: C.star_except(
    b.bronze, "source_file", "countryOrig", "countryDest", "_rescued_data", *C.BALANCES
))
simple("fraud_flag", lambda b: b.silver.select("id", C.fraud_flag("is_fraud").alias("is_fraud")))
simple("gold_by_country", lambda b: medallion.gold_by_country(b.gold, "N05").select(
    "id", "customer_id", "country", "amount"
))
simple("large_amount", lambda b: analytics.large_amount(b.gold).select("id", "amount", "is_fraud"))
@query
def customer_large_txns(b: Bank) -> DataFrame:
    """One customer's large transactions, each with the answer of a model."""
    model = ml.fit_rf(ml.split(_learnable(b))[0])
    named = {c: F.col("type") for c in ml.CATEGORICAL[1:]}
    return analytics.customer_large_scored(b.gold.withColumns(named), EMAIL, model, 100_000).select(
        "id", "nameOrig", "nameDest", "type", "amount", "fraud_prediction"
    )


simple("sample_rows", lambda b: analytics.top(b.bronze, 10, "id"))
simple("codes_like", lambda b: analytics.distinct_codes(b.countries, "N1%"))


def _doubtful(b: Bank) -> DataFrame:
    """Bronze with missing customers and amounts that are not positive or not there."""
    return b.bronze.withColumns(
        {
            "customer_id": F.when(F.col("type") != "DEBIT", F.col("customer_id")),
            "amount": F.when(F.col("step") != 500, F.col("amount") - 50_000),
        }
    )




@query
def expectations(b: Bank) -> DataFrame:
    """The rule counts, with balances as the text they arrive in, some of it no number."""
    unread = F.when(F.col("step") == 500, "abc").otherwise(F.col("oldBalanceOrig").cast("string"))
    rows = _doubtful(b).withColumn("oldBalanceOrig", unread)
    return medallion.apply_expectations(rows, medallion.BALANCE_RULES)[1]


simple("expectations_clean", lambda b: medallion.apply_expectations(_doubtful(b))[0].select(
    "id", "customer_id", "amount"
))
simple("feature_projection", lambda b: ml.features(b.gold, with_label=True))
simple("scored_since", lambda b: _ntz(live.since(b.scored, SINCE)))
simple("fraud_inbox", lambda b: _ntz(live.fraud_inbox(b.scored)))
simple("dashboard_filter", lambda b: analytics.filter_values(
    b.gold, "countryOrig", (F.col("type") == "TRANSFER") & F.col("is_fraud")
))

# --- joins ------------------------------------------------------------------

simple("silver_transactions", lambda b: b.silver)
simple("gold_transactions", lambda b: b.gold)
simple("gold_unmatched", lambda b: medallion.gold_unmatched(b.silver, b.countries, b.customers))
simple("window_range_join", lambda b: analytics.last_steps(b.gold).select("id", "step", "amount"))
simple("type_baseline_join", lambda b: _plain(risk.with_baseline(
    b.gold.select("id", "type", "amount"), risk.baseline(b.gold)
)))

# --- aggregations -----------------------------------------------------------

simple("fraud_amount_by_country", lambda b: _rounded(analytics.fraud_amount_by_country(_fine(b.gold))))
simple("country_flow_top20", lambda b: analytics.country_flow(b.gold))
simple("sankey_rollup", lambda b: analytics.sankey_rollup(analytics.country_flow(b.gold)))
simple("fraud_type_breakdown", lambda b: analytics.fraud_counts_by(b.gold))
simple("fraud_type_by_country", lambda b: analytics.fraud_counts_by(b.gold, "countryOrig"))
simple("type_bar", lambda b: analytics.type_bar(analytics.fraud_counts_by(b.gold, "countryOrig")))
simple("fraud_dest_countries", lambda b: analytics.fraud_destinations(
    analytics.fraud_amount_by_country(b.gold, n=None)
))
simple("fraud_over_time", lambda b: _rounded(analytics.fraud_over_time(_fine(b.gold), ANCHOR)))
simple("silver_counts", lambda b: analytics.counts_by(b.silver, "is_fraud", "source_file").orderBy(
    "source_file", "is_fraud"
))
simple("source_file_counts", lambda b: analytics.counts_by(b.bronze, "source_file"))
simple("amount_by_origin", lambda b: _rounded(analytics.sum_by(_fine(b.bronze), "countryOrig", "amount")))
simple("large_flows_rounded", lambda b: analytics.large_flows(_fine(b.gold)))
simple("fraud_counts", lambda b: analytics.counts_by(b.gold, "is_fraud"))
simple("table_count", lambda b: analytics.row_count(b.gold))


@query
def numeric_profile(b: Bank) -> DataFrame:
    stats = profile.numeric_profile(b.gold, exact=True)
    # Averages of doubles depend on the order of addition in the last digits.
    loose = [c for c in stats.columns if c.endswith(("_mean", "_stddev"))]
    return stats.withColumns({c: F.round(c, 3) for c in loose})


simple("type_frequencies", lambda b: profile.type_frequencies(b.gold))
simple("country_pairs_top80", lambda b: profile.country_pairs(b.gold))
simple("overall_stats", lambda b: profile.overall_stats(b.gold))
simple("type_stats", lambda b: _plain(risk.type_stats(b.gold, exact=True)))
simple("live_metrics", lambda b: live.live_metrics(_fine(b.scored)))
simple("live_country_flows", lambda b: live.live_flows(_fine(b.scored)))
simple("flow_bars", lambda b: live.flow_bars(live.live_flows(b.scored)))
simple("live_time_buckets", lambda b: live.live_buckets(b.scored))
simple("recent_fraud_rate", lambda b: live.recent_fraud_rate(b.scored, AS_OF, RECENT_MINUTES))
simple("pipeline_health", lambda b: _ntz(live.pipeline_health(b.scored, AS_OF)))
simple("max_id", lambda b: analytics.max_id(b.scored))
simple("cdc_row_counts", lambda b: cdc.cdc_row_counts(b.history))
simple("label_ratio", lambda b: analytics.counts_by(
    ml.features(b.gold, with_label=True).select(F.col("label").cast("int").alias("label")), "label"
))

# --- windows, top-k ---------------------------------------------------------

simple("cdc_current_state", lambda b: cdc.current_state(b.history))
simple("newest_live_id", lambda b: cdc.newest_key(b.history))
simple("latest_transactions", lambda b: _ntz(analytics.latest(b.scored)))
simple("latest_cdc_rows", lambda b: analytics.latest(b.history, 5, by="_lsn"))

# --- risk -------------------------------------------------------------------


@query
def risk_features(b: Bank) -> DataFrame:
    return _plain(risk.risk_features(b.gold, risk.baseline(b.gold)))


@query
def risk_scores(b: Bank) -> DataFrame:
    return risk.risk_scores(b.gold, risk.baseline(b.gold)).select("id", "risk_score")


def _without_numbers() -> Column:
    return F.transform("top_signals", lambda s: F.split_part(s, F.lit(" ("), F.lit(1)))


@query
def risk_signals(b: Bank) -> DataFrame:
    scored = risk.risk_scores(b.gold, risk.baseline(b.gold))
    return scored.select("id", F.concat_ws(" | ", "top_signals").alias("signals"))


@query
def risk_explanation(b: Bank) -> DataFrame:
    return risk.risk_scores(b.gold, risk.baseline(b.gold)).select("id", "explanation")


@query
def risk_feature_map(b: Bank) -> DataFrame:
    scored = risk.risk_scores(b.gold, risk.baseline(b.gold))
    names = ("found_count", "type", "amount", *C.BALANCES, "fraud_rate_type",
             "p50_amount_type", "p90_amount_type", "p95_amount_type", "p99_amount_type",
             "flag_type_prior", "flag_drains_origin", "flag_empty_dest", "flag_large_p95", "flag_large_p99")
    return scored.select(
        "id",
        F.size("features").alias("n_features"),
        *[F.col("features")[n].alias(n) for n in names],
    )


def _explained(found: DataFrame, missing: DataFrame) -> DataFrame:
    both = found.withColumn("asked", F.lit("known")).unionByName(
        missing.withColumn("asked", F.lit("unknown"))
    )
    return both.select(
        "asked",
        "risk_score",
        F.concat_ws(" | ", _without_numbers()).alias("signals"),
        F.col("features")["found_count"].alias("found_count"),
    )


@query
def explain_transaction_risk(b: Bank) -> DataFrame:
    stats = risk.baseline(b.gold)
    return _explained(
        risk.explain(b.gold, FOUND_ID, stats), risk.explain(b.gold, "no such id", stats)
    )


@query
def explain_sql_functions(b: Bank) -> DataFrame:
    """The SQL table functions, called by SQL text."""
    risk.register_functions(b.spark, b.gold, b.history)
    calls = (
        ("explain_transaction_risk", FOUND_ID),
        ("explain_transaction_risk", "no such id"),
        ("explain_live_transaction_risk", LIVE_ID),
        ("explain_live_transaction_risk", DELETED_ID),
    )
    return b.spark.sql(" UNION ALL ".join(
        f"SELECT '{name}' AS function, '{key}' AS asked, risk_score, "
        f"features['found_count'] AS found_count FROM {name}('{key}')"
        for name, key in calls
    ))


def _gold_by_file(b: Bank) -> DataFrame:
    rows = b.silver.withColumn("loaded_from", F.col("source_file"))
    return medallion.gold(rows, b.countries, b.customers, hints=b.hints)


@query
def baseline_parts(b: Bank) -> DataFrame:
    """The baseline of parts: two files, then the others, then one of them once more."""
    path, gold = work_dir(b.spark, "baseline"), _gold_by_file(b)
    early = F.col("loaded_from").isin(*FIRST_FILES)
    for rows in (gold.filter(early), gold.filter(~early), gold.filter(F.col("loaded_from") == "part-2.csv")):
        baseline_store.add_parts(rows, path, F.col("loaded_from"))
    return _plain(baseline_store.merged(b.spark, path))


@query
def explain_after_new_rows(b: Bank) -> DataFrame:
    """The SQL functions before and after two more files came to gold and to the baseline."""
    gold, path = work_dir(b.spark, "gold"), work_dir(b.spark, "baseline")
    answers = None
    for stage, early in (("before", True), ("after", False)):
        rows = _gold_by_file(b).filter(F.col("loaded_from").isin(*FIRST_FILES) == early)
        rows.write.mode("append").parquet(gold)
        baseline_store.add_parts(rows, path, F.col("loaded_from"))
        if early:
            stats = baseline_store.merged(b.spark, path)
            risk.register_functions(b.spark, b.spark.read.parquet(gold), stats=stats)
        else:
            risk.refresh_functions(b.spark)
        for asked in NEW_ROW_IDS:
            one = b.spark.sql(f"""SELECT '{stage}' AS stage, '{asked}' AS asked, risk_score,
                CAST(features['found_count'] AS BIGINT) AS found_count,
                CAST(features['p95_amount_type'] AS DOUBLE) AS p95 FROM explain_transaction_risk('{asked}')""")
            one = b.spark.createDataFrame(one.collect(), one.schema)  # one row, as it is now
            answers = one if answers is None else answers.unionByName(one)
    return answers


@query
def sql_views(b: Bank) -> DataFrame:
    """SQL over the registered views of the bank's tables."""
    pipeline.register_views(
        b.spark, b.bronze, b.reports, b.countries, b.customers,
        silver_rows=b.silver, change_log=b.history, scored=b.scored,
    )
    return b.spark.sql("""
        SELECT 'gold' AS name, type, count(*) AS n FROM gold_transactions GROUP BY type
        UNION ALL SELECT 'live', type, count(*) FROM live_transactions GROUP BY type
        UNION ALL SELECT 'scored', type, count(*) FROM scored_transactions GROUP BY type
    """)


@query
def explain_live_transaction_risk(b: Bank) -> DataFrame:
    stats = risk.baseline(b.gold)
    return _explained(
        risk.explain_live(b.history, b.gold, LIVE_ID, stats),
        risk.explain_live(b.history, b.gold, DELETED_ID, stats),
    )


@query
def live_risk_scores(b: Bank) -> DataFrame:
    stats = risk.baseline(b.gold)
    return risk.risk_scores(risk.live_transactions(b.history), stats, live=True).select(
        "id", "risk_score"
    )


# --- machine learning -------------------------------------------------------


@query
def split(b: Bank) -> DataFrame:
    train, test = ml.split(b.gold.select("id"))
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


def _train_test(b: Bank) -> tuple[DataFrame, DataFrame]:
    return ml.split(ml.features(b.gold, with_label=True))


def _learnable(b: Bank) -> DataFrame:
    """Model rows whose label is told by one feature, which both country names repeat.

    A forest learns such a label without error, so that SQL knows every prediction.
    """
    rows = ml.features(b.gold)
    return rows.withColumns({
        "countryOrig_name": F.col("type"),
        "countryDest_name": F.col("type"),
        "label": (F.col("type") == "TRANSFER").cast("float"),
    })


simple("category_counts", lambda b: ml.category_counts(
    b.gold.withColumn("countryDest_name", F.nullif(F.col("countryDest_name"), F.lit("NATION_3")))
))


@query
def preprocess(b: Bank) -> DataFrame:
    """Filled inputs of the model, with unfilled gaps made in two columns first."""
    gaps = ml.features(b.gold, with_label=True).withColumns(
        {
            "amount": F.when(F.col("type") != "DEBIT", F.col("amount")),
            "countryDest_name": F.nullif(F.col("countryDest_name"), F.lit("NATION_3")),
        }
    )
    model = PipelineModel(ml.fit_preprocessing(gaps))
    rows = model.transform(gaps).withColumn("all", vector_to_array("features"))
    n = len(ml.NUMERIC)
    ones = F.transform("all", lambda v, i: F.when((i >= n) & (v == 1), i).otherwise(0))  # places of the codes
    return rows.select(
        "id",
        "countryDest_name_f",
        *[F.get("all", F.lit(i)).alias(f"{c}_f") for i, c in enumerate(ml.NUMERIC)],
        F.size("all").alias("width"),
        F.array_join(F.filter(ones, lambda i: i > 0), " ").alias("ones"),
    )


@query
def train_rf(b: Bank) -> DataFrame:
    train, test = ml.split(_learnable(b))
    p = F.col("fraud_probability")
    return ml.predict(test, ml.fit_rf(train)).select(
        "id", "label", "fraud_prediction", ((p >= 0) & (p <= 1)).alias("is_probability")
    )


@query
def score_batch(b: Bank) -> DataFrame:
    model = ml.fit_rf(ml.split(_learnable(b))[0])
    return ml.predict(_learnable(b).drop("label"), model).drop("fraud_probability", *ml.CATEGORICAL[1:])


@query
def prediction_counts(b: Bank) -> DataFrame:
    return analytics.counts_by(score_batch(b), "fraud_prediction")


@query
def feature_importance(b: Bank) -> DataFrame:
    train, _ = _train_test(b)
    return ml.importances(ml.fit_rf(train), train)


@query
def grid_search(b: Bank) -> DataFrame:
    return ml.grid_search(*ml.split(_learnable(b)))[0]


@query
def select_best(b: Bank) -> DataFrame:
    return ml.best(ml.grid_search(*ml.split(_learnable(b)))[0])


@query
def evaluate(b: Bank) -> DataFrame:
    """Metrics of a fixed prediction: large transfers are called fraud."""
    said = (F.col("type") == "TRANSFER") & (F.col("amount") > 200_000)
    fixed = b.gold.select(F.col("is_fraud").alias("label"), said.alias("prediction"))
    return ml.evaluate(fixed)


@query
def evaluate_ranked(b: Bank) -> DataFrame:
    """The ranked area of a score with ties and errors."""
    wrong = F.col("id") % 7 == 0
    label = F.when(wrong, ~F.col("fraud_prediction")).otherwise(F.col("fraud_prediction"))
    score = F.floor(F.col("fraud_probability") * 40)
    found = ml.ranked_auc(b.scored.select(label.alias("label"), score.alias("fraud_probability")))
    return found.withColumn("auc", F.round("auc", 9))


@query
def score_threshold(b: Bank) -> DataFrame:
    """One model's answers for three limits, the last above any probability."""
    rows = _learnable(b)
    model = ml.fit_rf(ml.split(rows)[0])
    said = rows
    for name, limit in (("at_none", 0.0), ("at_half", 0.5), ("at_most", 1.1)):
        said = ml.predict(said, model, limit).withColumnRenamed("fraud_prediction", name).drop("fraud_probability")
    return said.select("id", "at_none", "at_half", "at_most")

# --- versions of a dimension ------------------------------------------------


def _versions(b: Bank) -> str:
    path = work_dir(b.spark, "countries")
    snapshots.publish(b.countries, path)
    snapshots.delete_where(b.spark, path, "alpha3_code = 'N05'")
    return path


@query
def snapshot_publish(b: Bank) -> DataFrame:
    return snapshots.history(b.spark, _versions(b)).select("version", "operation", "rows")


@query
def snapshot_delete(b: Bank) -> DataFrame:
    return snapshots.as_of(b.spark, _versions(b)).select("alpha3_code", "country")


@query
def snapshot_as_of(b: Bank) -> DataFrame:
    return snapshots.as_of(b.spark, _versions(b), 0).select("alpha3_code", "country")


@query
def snapshot_restore(b: Bank) -> DataFrame:
    path = _versions(b)
    version = snapshots.restore(b.spark, path, 0)
    return snapshots.as_of(b.spark, path).select(
        "alpha3_code", "country", F.lit(version).alias("version")
    )


@query
def gold_impact(b: Bank) -> DataFrame:
    path = _versions(b)
    before, after = (snapshots.as_of(b.spark, path, v) for v in (0, 1))
    return snapshots.gold_impact(b.silver, b.customers, before, after)


# --- streaming --------------------------------------------------------------


def _event_stream(b: Bank) -> DataFrame:
    # A glob matches the table both as one file and as a folder of files.
    schema = b.table("events").schema
    return scored_from(b.spark.readStream.schema(schema).parquet(b.path("events") + "*"))


def _finished(b: Bank, result: DataFrame, mode: str, **options) -> DataFrame:
    target = work_dir(b.spark, "live")
    jobs.publish_latest(
        result, target, f"{target}-checkpoint", mode, trigger=jobs.ONCE, **options
    ).awaitTermination()
    return jobs.read_latest(b.spark, target)


@query
def silver_stream(b: Bank) -> DataFrame:
    target, landing = work_dir(b.spark, "silver"), work_dir(b.spark, "bronze")
    _doubtful(b).write.parquet(landing)
    stream = b.spark.readStream.schema(_doubtful(b).schema).parquet(landing)
    (
        jobs.silver_stream(stream, b.reports)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", f"{target}-checkpoint")
        .trigger(**jobs.ONCE)
        .start()
        .awaitTermination()
    )
    return b.spark.read.parquet(target).select(
        "id", "customer_id", "amount", "countryOrig", "countryDest", "is_fraud"
    )


simple("stream_metrics", lambda b: _finished(b, jobs.stream_metrics(_fine(_event_stream(b))), "complete"))
simple("stream_country_flows", lambda b: _finished(
    b, jobs.stream_country_flows(_fine(_event_stream(b))), "complete", top_n=30
))
simple("stream_time_buckets", lambda b: _finished(
    b, jobs.stream_time_buckets(_event_stream(b)), "complete"
))


def _delivered(b: Bank, rows: DataFrame, part: int, path: str) -> DataFrame:
    """Stream of the files below ``path``, to which ``rows`` are added as one."""
    rows.coalesce(1).write.parquet(f"{path}/part={part}")
    return b.spark.readStream.schema(rows.schema).parquet(f"{path}/*")


@query
def stream_late_rows(b: Bank) -> DataFrame:
    """Buckets under a watermark, and the rows it dropped, over three deliveries.

    A tenth of the early rows comes last, when the watermark is past their time.
    """
    landing, target = work_dir(b.spark, "events"), work_dir(b.spark, "buckets")
    rows = b.scored.select("id", "timestamp", "fraud_prediction")
    early = F.col("timestamp") < F.lit(SPLIT).cast("timestamp")
    held_back = early & (F.col("id") % 10 == 0)
    for part, wanted in enumerate((early & ~held_back, ~early, held_back)):
        stream = _delivered(b, rows.filter(wanted), part, landing)
        with progress.recorded(b.spark, f"{target}-progress", f"{target}-checkpoint") as log:
            (
                jobs.stream_time_buckets(stream, delay=DELAY, key="id")
                .writeStream.outputMode("append").format("parquet").queryName(log.run)
                .option("path", target).option("checkpointLocation", f"{target}-checkpoint")
                .trigger(**jobs.ONCE).start().awaitTermination()
            )
    buckets = b.spark.read.parquet(target).withColumn("kind", F.lit("bucket"))
    late = progress.batches(b.spark, f"{target}-progress").agg(F.sum("late_rows").alias("total"))
    none = F.lit(None).cast("bigint")
    return buckets.unionByName(late.select(
        F.lit("late").alias("kind"), none.alias("timestamp"), "total", none.alias("fraud"), none.alias("legit")
    ))


@query
def stream_expectations(b: Bank) -> DataFrame:
    """Rule counts of a stream of three deliveries and a restart without new rows."""
    landing, target = work_dir(b.spark, "bronze"), work_dir(b.spark, "silver")
    for part in (0, 1, 2, 2):
        path = f"{landing}/{part}"
        if part != 2 or not folders.names(b.spark, path):
            _doubtful(b).filter(F.col("step") % 3 == part).coalesce(2).write.parquet(path)
        stream = b.spark.readStream.schema(_doubtful(b).schema).parquet(f"{landing}/*")
        with progress.recorded(b.spark, f"{target}-progress", f"{target}-checkpoint") as log:
            (
                jobs.silver_stream(stream, b.reports)
                .writeStream.format("parquet").queryName(log.run)
                .option("path", target).option("checkpointLocation", f"{target}-checkpoint")
                .trigger(**jobs.ONCE).start().awaitTermination()
            )
    counts = progress.observed(b.spark, f"{target}-progress", "expectations")
    return counts.select(F.col("name").alias("rule"), F.col("value").alias("violations"))


@query
def stream_by_the_clock(b: Bank) -> DataFrame:
    """Micro-batches by the clock, one file each; stopped half way and started again."""
    landing, target = work_dir(b.spark, "events"), work_dir(b.spark, "dedup")
    checkpoint = f"{target}-checkpoint"
    for part in range(6):
        rows = b.scored.filter(F.col("id") % 6 == part)
        again = b.scored.filter((F.col("id") % 6 < part) & (F.col("id") % 4 == 0)).withColumn("amount", -F.col("amount"))
        rows.unionByName(again).coalesce(1).write.mode("append").parquet(landing)
    stream = b.spark.readStream.schema(b.scored.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    clock = {"processingTime": "200 milliseconds"}
    with progress.recorded(b.spark, f"{target}-progress", checkpoint) as log:
        query = jobs.dedup_into(stream, target, checkpoint, trigger=clock, name=log.run)
        while query.isActive and (query.lastProgress is None or query.lastProgress.batchId < 2):
            query.awaitTermination(0.2)
        query.stop()
    with progress.recorded(b.spark, f"{target}-progress", checkpoint) as log:
        query = jobs.dedup_into(stream, target, checkpoint, trigger=clock, name=log.run)
        query.processAllAvailable()
        query.stop()
    ran = progress.batches(b.spark, f"{target}-progress").filter("input_rows > 0").count()
    return tables.read_scored(b.spark, target).select(
        "id", "type", "amount", F.lit(ran >= 3).alias("several_batches")
    )


@query
def stream_dedup(b: Bank) -> DataFrame:
    """Newest rows first, older ones later, repeats in each; every batch a new checkpoint."""
    landing, target = work_dir(b.spark, "events"), work_dir(b.spark, "dedup")
    for n, rest in enumerate((2, 1, 0)):
        rows = b.scored.filter(F.col("id") % 3 == rest)
        later = F.col("timestamp") + F.make_dt_interval(hours=F.lit(1))
        again = b.scored.filter(F.col("id") % 3 >= rest)
        again = again.withColumns({"amount": F.col("amount") + 1, "timestamp": later})
        older = rows.withColumn("timestamp", F.col("timestamp") - F.make_dt_interval(days=F.lit(n)))
        older.unionByName(again).write.parquet(f"{landing}/{n}")
        stream = b.spark.readStream.schema(b.scored.schema).parquet(f"{landing}/{n}")
        for _ in range(2):  # a restart finds nothing new
            jobs.dedup_into(
                stream, target, f"{target}-checkpoint-{n}", trigger=jobs.ONCE
            ).awaitTermination()
    return tables.read_scored(b.spark, target).select("id", "type", "amount")


@query
def stream_dedup_window(b: Bank) -> DataFrame:
    """Each row twice; one of the two passes, without a look at what is stored."""
    target = work_dir(b.spark, "unique")
    twice = _event_stream(b).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    (
        jobs.dedup(twice.select("id", "type", "amount"), delay="1 hour")
        .writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", f"{target}-checkpoint")
        .trigger(**jobs.ONCE).start().awaitTermination()
    )
    return b.spark.read.parquet(target)


@query
def stream_cdc_current(b: Bank) -> DataFrame:
    log, target = work_dir(b.spark, "log"), work_dir(b.spark, "current")
    schema = b.history.schema
    # Three deliveries: inserts, later changes, deletes; each is one micro-batch.
    deliveries = (["insert"], ["update_preimage", "update_postimage"], ["delete"])
    for part in deliveries:
        b.history.filter(F.col("_change_type").isin(part)).write.mode("append").parquet(log)
        jobs.stream_current(
            b.spark.readStream.schema(schema).parquet(log),
            target,
            f"{target}-checkpoint",
            trigger=jobs.ONCE,
        ).awaitTermination()
    return jobs.read_current(b.spark, target)


@query
def stream_score(b: Bank) -> DataFrame:
    model = ml.fit_rf(ml.split(_learnable(b))[0])
    silver = b.silver.withColumns({"country_orig": F.col("type"), "country_dest": F.col("type")})
    message = F.to_json(
        F.struct(
            F.col("id").cast("bigint").alias("id"),
            F.lit(ANCHOR).alias("timestamp"),
            "type",
            "amount",
            F.col("customer_id").cast("int").alias("customer_id"),
            "country_orig",
            "country_dest",
            F.col("oldBalanceOrig").alias("old_balance_orig"),
            F.col("newBalanceOrig").alias("new_balance_orig"),
            F.col("oldBalanceDest").alias("old_balance_dest"),
            F.col("newBalanceDest").alias("new_balance_dest"),
            F.col("diffOrig").alias("diff_orig"),
            F.col("diffDest").alias("diff_dest"),
        )
    )
    inbox, target = work_dir(b.spark, "messages"), work_dir(b.spark, "scored")
    silver.select(message.alias("value")).write.text(inbox)
    for _ in range(2):  # restart with nothing new
        jobs.stream_score(
            b.spark.readStream.text(inbox), model, target, f"{target}-checkpoint", jobs.ONCE
        ).awaitTermination()
    return tables.read_scored(b.spark, target).select(
        "id", "type", "amount", "old_balance_orig", "new_balance_dest",
        "fraud_prediction",
    )
