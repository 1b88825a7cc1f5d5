"""Migration assessment over catalog extracts that are derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import dml, generate, migration
from lakeloom.operators.topk import top
from lakeloom.plans.registry import query

DB = "'DB_' || ({} % 20) AS db_name"

# extract -> (table, column expressions); the expressions are valid in both engines
CATALOGS: dict[str, tuple[str, list[str]]] = {
    "configurations": ("supplier", [DB.format("s_suppkey"), "CASE WHEN s_nationkey % 5 = 0 THEN 'xp_cmdshell' ELSE 'option_' || s_nationkey END AS name",
                                    "CASE WHEN s_acctbal > 8000 THEN 1 ELSE 0 END AS value_in_use"]),
    "server_properties": ("supplier", [DB.format("s_suppkey"), "'FilestreamEffectiveLevel' AS name",
                                       "CASE WHEN s_acctbal < -900 THEN 2 ELSE 0 END AS filestream_level"]),
    "jobs": ("orders", [DB.format("o_orderkey"), "o_orderkey AS job_id", "CASE o_orderpriority WHEN '1-URGENT' THEN 'syspolicy_purge_history' "
                        "WHEN '2-HIGH' THEN 'sp_delete_backuphistory' ELSE 'job_' || o_orderkey END AS name",
                        "CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS enabled"]),
    "steps": ("lineitem", ["l_orderkey AS job_id", "'step_' || l_linenumber || '_' || l_partkey AS step_name",
                           "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'CmdExec' WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'PowerShell' "
                           "WHEN l_returnflag = 'R' THEN 'SSIS' ELSE 'TSQL' END AS subsystem"]),
    "maintenance_plans": ("nation", [DB.format("n_nationkey"), "'plan_' || n_name AS name"]),
    "mail_profiles": ("region", [DB.format("r_regionkey"), "'mail_' || r_name AS name"]),
    "alerts": ("benchmark", [DB.format("item_id"), "'alert_' || item_id AS name"]),
    "servers": ("supplier", [DB.format("s_suppkey"), "s_name AS name", "CASE s_nationkey % 3 WHEN 0 THEN 'SQL Server' WHEN 1 THEN 'Oracle' ELSE 'MySQL' END AS product",
                             "'provider_' || (s_nationkey % 4) AS provider", "CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS is_linked"]),
    "modules": ("documents", [DB.format("doc_id"), "'dbo.proc_' || doc_id AS name",
                              "CASE lang WHEN 'fr' THEN text || ' BEGIN DISTRIBUTED TRANSACTION' WHEN 'de' THEN text || ' OPENROWSET(x)' WHEN 'es' THEN "
                              "text || ' EXEC sp_configure; SELECT * FROM a, b WHERE a.x *= b.x' ELSE text || CASE WHEN n_chars > 2000 THEN "
                              "' SELECT * FROM [other].dbo.t GROUP BY ALL x' ELSE '' END END AS definition"]),
    "assemblies": ("part", [DB.format("p_partkey"), "'asm_' || p_partkey AS name", "CASE WHEN p_size > 5 THEN 1 ELSE 0 END AS is_user_defined",
                            "CASE p_type WHEN 'ECONOMY' THEN 'UNSAFE_ACCESS' WHEN 'PROMO' THEN 'EXTERNAL_ACCESS' ELSE 'SAFE_ACCESS' END AS permission_set_desc"]),
    "objects": ("part", [DB.format("p_partkey"), "p_partkey AS object_id", "'dbo.' || p_name AS name", "CASE p_size % 4 WHEN 0 THEN 'P' WHEN 1 THEN 'FN' WHEN 2 THEN 'V' ELSE 'U' END AS type",
                         "CASE WHEN p_retailprice > 1800 THEN 1 ELSE 0 END AS is_ms_shipped"]),
    "server_triggers": ("customer", [DB.format("c_custkey"), "c_name AS name", "c_custkey AS object_id", "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS is_disabled"]),
    "databases": ("supplier", [DB.format("s_suppkey"), "'DB_' || s_suppkey AS name", "s_suppkey AS database_id",
                               "CASE WHEN s_nationkey % 6 = 0 THEN 1 ELSE 0 END AS is_published", "CASE WHEN s_nationkey % 11 = 0 THEN 1 ELSE 0 END AS is_merge_published",
                               "CASE WHEN s_acctbal > 5000 THEN 1 ELSE 0 END AS is_cdc_enabled", "CASE WHEN s_nationkey % 4 = 1 THEN 1 ELSE 0 END AS is_broker_enabled",
                               "CASE WHEN s_acctbal < 1000 THEN 1 ELSE 0 END AS is_encrypted", "CAST(80 + 10 * (s_nationkey % 8) AS INT) AS compatibility_level",
                               "CASE WHEN s_nationkey % 3 = 0 THEN 'Japanese_CI_AS' ELSE 'SQL_Latin1_General_CP1_CI_AS' END AS collation_name"]),
    "publications": ("nation", [DB.format("n_nationkey"), "'pub_' || n_name AS name", "n_regionkey % 3 AS publication_type"]),
    "change_tracking": ("region", [DB.format("r_regionkey"), "r_name AS name"]),
    "queues": ("nation", [DB.format("n_nationkey"), "'queue_' || n_name AS name", "CASE WHEN n_regionkey = 2 THEN 'dbo.activate' END AS activation_procedure"]),
    "fulltext_catalogs": ("region", [DB.format("r_regionkey"), "'ft_' || r_name AS name"]),
    "filegroups": ("nation", [DB.format("n_nationkey"), "'fg_' || n_name AS name", "CASE WHEN n_regionkey = 1 THEN 'FX' ELSE 'FG' END AS type"]),
    "user_tables": ("part", [DB.format("p_partkey"), "'dbo.t_' || p_partkey AS name", "CASE WHEN p_size > 45 THEN 2 ELSE 0 END AS temporal_type"]),
    "partition_functions": ("region", [DB.format("r_regionkey"), "'pf_' || r_name AS name"]),
    "partitions": ("lineitem", [DB.format("l_partkey"), "l_partkey AS object_id", "'p_' || l_partkey || '_' || l_linenumber AS name", "CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS data_compression",
                                "l_linenumber % 3 AS index_id", "CAST(l_quantity AS BIGINT) AS row_count"]),
    "principals": ("customer", [DB.format("c_custkey"), "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'NT ' || c_name ELSE c_name END AS name",
                                "CASE c_nationkey % 3 WHEN 0 THEN 'U' WHEN 1 THEN 'G' ELSE 'S' END AS type"]),
    "sql_logins": ("customer", [DB.format("c_custkey"), "CASE WHEN c_mktsegment = 'BUILDING' THEN '##' || c_name ELSE c_name END AS name"]),
    "column_keys": ("region", [DB.format("r_regionkey"), "'key_' || r_name AS name"]),
    "security_policies": ("nation", [DB.format("n_nationkey"), "'policy_' || n_name AS name"]),
    "files": ("lineitem", [DB.format("l_suppkey"), "l_suppkey AS database_id", "'file_' || l_partkey AS name", "CAST(floor(l_extendedprice * 100) AS BIGINT) AS size"]),
}


def catalog(f, name: str):
    if name == "job_steps":
        j = catalog(f, "jobs")
        return j.join(catalog(f, "steps"), "job_id").withColumnRenamed("name", "job_name").withColumnRenamed("step_name", "name")
    table, exprs = CATALOGS[name]
    return getattr(f, table).selectExpr(*exprs)


def cat_sql(name: str) -> str:
    if name == "job_steps":
        return f"(SELECT j.db_name, j.name AS job_name, s.step_name AS name, s.subsystem FROM {cat_sql('jobs')} j JOIN {cat_sql('steps')} s ON j.job_id = s.job_id)"
    table, exprs = CATALOGS[name]
    return f"(SELECT {', '.join(exprs)} FROM {table})"


def feature_sql(features) -> str:
    return " UNION ALL ".join(f"SELECT '{x.id}' AS feature_id, db_name, name AS object_name FROM {cat_sql(x.catalog)} WHERE {x.predicate}" for x in features)


def inventory(f, *ids: str):
    feats = [x for x in migration.FEATURES if not ids or x.id in ids]
    return migration.findings({c: catalog(f, c) for c in {x.catalog for x in feats}}, feats)


def register(name: str, *ids: str) -> None:
    feats = [x for x in migration.FEATURES if x.id in ids]
    query(name, feature_sql(feats))(lambda f: inventory(f, *ids))


query("feature_inventory", feature_sql(migration.FEATURES))(lambda f: inventory(f))
register("feat_settings", "1-1", "1-2")
register("feat_linked", "3-1", "3-2")
register("feat_db_flags", "5-1", "5-2", "5-3", "5-4", "5-5", "6-1", "8-3")
register("feat_logins", "8-1", "8-2")


TRIGGER_SQL = f"""SELECT t.name, t.is_disabled, e.o_orderpriority AS event_group FROM {cat_sql('server_triggers')} t
LEFT JOIN (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) e ON t.object_id = e.o_custkey"""


def triggers(f):
    e = f.orders.select(F.col("o_custkey").alias("object_id"), F.col("o_orderpriority").alias("event_group")).distinct()
    return catalog(f, "server_triggers").join(e, "object_id", "left").select("name", "is_disabled", "event_group")


query("feat_triggers", TRIGGER_SQL)(triggers)


@query("left_join_catalog", f"SELECT name, is_disabled, count(event_group) AS events FROM ({TRIGGER_SQL}) GROUP BY 1, 2")
def _left_join_catalog(f):
    return triggers(f).groupBy("name", "is_disabled").agg(F.count("event_group").alias("events"))


@query("feat_job_steps", f"SELECT job_name, name AS step_name, subsystem FROM {cat_sql('job_steps')} WHERE subsystem IN ('CmdExec', 'PowerShell', 'SSIS', 'ISAPACKAGE')")
def _steps(f):
    return catalog(f, "job_steps").where(F.col("subsystem").isin("CmdExec", "PowerShell", "SSIS", "ISAPACKAGE")).select(
        "job_name", F.col("name").alias("step_name"), "subsystem")


@query("feat_jobs", f"""SELECT 'job' AS kind, name FROM {cat_sql('jobs')} WHERE name NOT IN ('syspolicy_purge_history', 'sp_delete_backuphistory', 'sp_purge_jobhistory')
UNION ALL SELECT 'plan', name FROM {cat_sql('maintenance_plans')} UNION ALL SELECT 'mail', name FROM {cat_sql('mail_profiles')} UNION ALL SELECT 'alert', name FROM {cat_sql('alerts')}""")
def _jobs(f):
    kinds = F.create_map(*[F.lit(x) for p in (("2-1", "job"), ("2-2", "plan"), ("2-3", "mail"), ("2-4", "alert")) for x in p])
    return inventory(f, "2-1", "2-2", "2-3", "2-4").select(kinds[F.col("feature_id")].alias("kind"), F.col("object_name").alias("name"))


CODE = [x for x in migration.FEATURES if x.catalog == "modules"] + migration.OLD_SYNTAX


@query("feat_code_patterns", feature_sql(CODE))
def _code(f):
    return migration.findings({"modules": catalog(f, "modules")}, CODE)


@query("feat_objects", f"""SELECT '4-3' AS feature_id, db_name, type AS detail, count(*) AS n FROM {cat_sql('objects')} WHERE type IN ('P', 'FN', 'V') AND is_ms_shipped = 0 GROUP BY 2, 3
UNION ALL SELECT feature_id, db_name, NULL, count(*) FROM ({feature_sql([x for x in migration.FEATURES if x.id in ('4-1', '4-2', '6-2', '7-1', '7-2', '7-3', '7-4', '7-5', '8-4', '8-5')])}) GROUP BY 1, 2""")
def _objects(f):
    o = catalog(f, "objects").where("type IN ('P', 'FN', 'V') AND is_ms_shipped = 0").groupBy("db_name", F.col("type").alias("detail")).agg(
        F.count(F.lit(1)).alias("n")).select(F.lit("4-3").alias("feature_id"), "db_name", "detail", "n")
    rest = inventory(f, "4-1", "4-2", "6-2", "7-1", "7-2", "7-3", "7-4", "7-5", "8-4", "8-5").groupBy("feature_id", "db_name").agg(
        F.count(F.lit(1)).alias("n")).select("feature_id", "db_name", F.lit(None).cast("string").alias("detail"), "n")
    return o.unionByName(rest)


SIZES = f"SELECT db_name, CAST(sum(size) * 8 // 1024 // 1024 AS BIGINT) AS size_gb FROM {cat_sql('files')} GROUP BY 1"


def sizes(f):
    return catalog(f, "files").groupBy("db_name").agg(F.expr("sum(size) * 8 div 1024 div 1024").alias("size_gb"))


DECISION_SQL = feature_sql(migration.FEATURES)


@query("target_decision", f"""WITH x AS ({DECISION_SQL}), a AS (SELECT db_name, max(size) > 15000000 AS oltp, min(size) < 50000000 AS read_only, count(*) > 2900 AS big_or_rare
FROM {cat_sql('files')} GROUP BY 1), g AS (SELECT db_name, max(CASE WHEN feature_id IN {migration.VM_ONLY} THEN 1 ELSE 0 END) AS vm,
max(CASE WHEN feature_id IN {migration.MI_AT_LEAST} THEN 1 ELSE 0 END) AS mi FROM x GROUP BY 1)
SELECT a.db_name, CASE WHEN vm = 1 THEN 'SQL on VM' WHEN mi = 1 THEN 'SQL MI' WHEN oltp THEN 'SQL DB Serverless' WHEN read_only AND big_or_rare THEN 'Synapse + ADLS'
ELSE 'SQL DB Serverless' END AS target FROM a LEFT JOIN g ON a.db_name = g.db_name""")
def _target(f):
    answers = catalog(f, "files").groupBy("db_name").agg(
        (F.max("size") > 15000000).alias("oltp"), (F.min("size") < 50000000).alias("read_only"), (F.count(F.lit(1)) > 2900).alias("big_or_rare"))
    return migration.target_decision(inventory(f), answers).select("db_name", "target")


METHOD = "CASE WHEN read_only THEN 'Parquet export' WHEN size_gb < 200 AND downtime_ok THEN 'BACPAC' ELSE 'DMS' END"


@query("method_decision", f"""SELECT db_name, size_gb, {METHOD} AS method FROM (SELECT *, size_gb % 2 = 0 AS downtime_ok, size_gb % 7 = 0 AS read_only FROM ({SIZES}))""")
def _method(f):
    s = sizes(f).withColumn("downtime_ok", F.col("size_gb") % 2 == 0).withColumn("read_only", F.col("size_gb") % 7 == 0)
    return s.select("db_name", "size_gb", migration.method_decision().alias("method"))


@query("reconcile_counts", """SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS copy_rows, FALSE AS equal
UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer), TRUE UNION ALL SELECT 'part', (SELECT count(*) FROM part), NULL, FALSE""")
def _counts(f):
    return migration.reconcile_counts({"orders": f.orders, "customer": f.customer, "part": f.part},
                                      {"orders": f.orders.where("o_orderstatus <> 'P'"), "customer": f.customer})


@query("table_row_counts", f"""SELECT o.name, o.object_id, CAST(sum(p.row_count) AS BIGINT) AS n_rows FROM {cat_sql('objects')} o JOIN {cat_sql('partitions')} p ON o.object_id = p.object_id
WHERE p.index_id IN (0, 1) AND o.type = 'U' GROUP BY 1, 2""")
def _table_rows(f):
    o = catalog(f, "objects").where("type = 'U'").select("object_id", "name")
    p = catalog(f, "partitions").where(F.col("index_id").isin(0, 1)).groupBy("object_id").agg(F.sum("row_count").alias("n_rows"))
    return o.join(p, "object_id").select("name", "object_id", "n_rows").orderBy(F.col("n_rows").desc(), "object_id")


@query("reconcile_ranges", """SELECT DISTINCT l_orderkey, 'changed' AS status FROM lineitem WHERE l_orderkey BETWEEN 500 AND 900 AND l_linenumber = 2
UNION ALL SELECT DISTINCT l_orderkey, 'missing' FROM lineitem WHERE l_orderkey BETWEEN 1000 AND 1100
UNION ALL SELECT DISTINCT -l_orderkey, 'extra' FROM lineitem WHERE l_orderkey BETWEEN 1 AND 50""")
def _ranges(f):
    """All order lines against a copy in which one stretch of orders has drifted, one is lost and one came twice under other keys."""
    drift = F.col("l_orderkey").between(500, 900) & (F.col("l_linenumber") == 2)
    copy = f.lineitem.where(~F.col("l_orderkey").between(1000, 1100)) \
        .withColumn("l_quantity", F.when(drift, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    extra = f.lineitem.where(F.col("l_orderkey").between(1, 50)).withColumn("l_orderkey", -F.col("l_orderkey"))
    return migration.reconcile_ranges(f.lineitem, copy.unionByName(extra), "l_orderkey", 1024)


@query("reconcile_hash", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'missing' ELSE 'changed' END AS status FROM orders
WHERE o_orderstatus = 'P' OR (o_orderpriority = '1-URGENT' AND o_totalprice > 400000)
UNION ALL SELECT DISTINCT o_orderkey, 'changed' FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 50 = 0
AND NOT (o_orderpriority = '1-URGENT' AND o_totalprice > 400000)""")
def _hash(f):
    """Besides changed prices, the copy swaps a value with a NULL or repeats a row of some finished orders."""
    odd = (F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 50 == 0)
    src = f.orders.withColumn("a", F.lit(1)).withColumn("b", F.lit(None).cast("int"))
    drift = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000)
    copy = src.where("o_orderstatus <> 'P'").withColumn("o_totalprice", F.when(drift, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    even = F.col("o_orderkey") % 100 == 0
    copy = copy.withColumn("a", F.when(odd & even, F.lit(None)).otherwise(F.lit(1))).withColumn("b", F.when(odd & even, F.lit(1)))
    copy = copy.unionByName(copy.where(odd & ~even))
    return migration.reconcile_rows(src, copy, "o_orderkey")


@query("latest_rows", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 5")
def _latest(f):
    return top(f.orders.select("o_orderkey", "o_custkey", "o_orderdate"), [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 5)


@query("db_file_sizes", f"SELECT db_name, name, size, size * 8 // 1024 AS size_mb FROM {cat_sql('files')}")
def _files(f):
    return catalog(f, "files").select("db_name", "name", "size", F.expr("size * 8 div 1024").alias("size_mb"))


@query("size_limit_check", f"""SELECT db_name, size_gb, service, CAST(limit_tb AS INT) AS limit_tb, size_gb <= limit_tb * 1024 AS fits FROM ({SIZES})
CROSS JOIN (VALUES {', '.join(str(x) for x in migration.SIZE_LIMITS_TB)}) l(service, limit_tb)""")
def _limits(f):
    return migration.size_limit_check(sizes(f))


@query("collation_check", f"SELECT name, collation_name FROM {cat_sql('databases')} WHERE collation_name <> '{migration.DEFAULT_COLLATION}'")
def _collation(f):
    return catalog(f, "databases").where(F.col("collation_name") != migration.DEFAULT_COLLATION).select("name", "collation_name")


@query("compat_check", f"SELECT name, compatibility_level, compatibility_level >= 100 AS ok FROM {cat_sql('databases')}")
def _compat(f):
    return catalog(f, "databases").select("name", "compatibility_level", (F.col("compatibility_level") >= 100).alias("ok"))


@query("apply_changes", """WITH l AS (SELECT c_custkey, op, c_acctbal FROM changes QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1)
SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM l) UNION ALL SELECT c_custkey, c_acctbal FROM l WHERE op <> 'D'""", "changes")
def _changes(f):
    return dml.apply_changes(f.customer.select("c_custkey", "c_acctbal"), f.changes(), "c_custkey")


@query("synthetic_sales", """SELECT i AS sales_id, CAST(DATE '2001-07-15' - CAST(i % 36500 AS INT) AS DATE) AS sales_date, 'P00' || (i % 3 + 1) AS product_code, '製品' || chr(CAST(65 + i % 3 AS INT)) AS product_name,
i * 10 AS quantity, CAST(i * 100 AS DOUBLE) AS unit_price, CAST(i * 10 * i * 100 AS DOUBLE) AS total_amount, CASE i % 3 WHEN 0 THEN '東京' WHEN 1 THEN '大阪' ELSE '名古屋' END AS region
FROM (SELECT o_orderkey + 1 AS i FROM orders)""")
def _synthetic(f):
    s = generate.numbered_sales(f.orders.select((F.col("o_orderkey") + 1).alias("i")), "i", f.as_of)
    return s.withColumn("unit_price", F.col("unit_price").cast("double")).withColumn("total_amount", F.col("total_amount").cast("double"))
