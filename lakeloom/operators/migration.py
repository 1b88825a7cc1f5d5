"""Migration assessment over captured catalog extracts, and reconciliation of copies."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType

from lakeloom.session import shared_dir


@dataclass(frozen=True)
class Feature:
    """A check: rows of one catalog extract that meet the predicate use the feature."""

    id: str
    catalog: str
    predicate: str


# Check numbers and the conditions on the catalog extracts.
FEATURES = [
    Feature("1-1", "configurations", "name = 'xp_cmdshell' AND value_in_use = 1"),
    Feature("1-2", "server_properties", "filestream_level <> 0"),
    Feature("1-3", "job_steps", "subsystem IN ('CmdExec', 'PowerShell')"),
    Feature("1-4", "job_steps", "subsystem IN ('SSIS', 'ISAPACKAGE')"),
    Feature("2-1", "jobs", "name NOT IN ('syspolicy_purge_history', 'sp_delete_backuphistory', 'sp_purge_jobhistory')"),
    Feature("2-2", "maintenance_plans", "TRUE"),
    Feature("2-3", "mail_profiles", "TRUE"),
    Feature("2-4", "alerts", "TRUE"),
    Feature("3-1", "servers", "is_linked = 1 AND product = 'SQL Server'"),
    Feature("3-2", "servers", "is_linked = 1 AND product <> 'SQL Server'"),
    Feature("3-3", "modules", "definition LIKE '%DISTRIBUTED TRANSACTION%'"),
    Feature("3-4", "modules", "definition LIKE '%OPENROWSET%' OR definition LIKE '%OPENDATASOURCE%'"),
    Feature("4-1", "assemblies", "is_user_defined = 1 AND permission_set_desc = 'SAFE_ACCESS'"),
    Feature("4-2", "assemblies", "is_user_defined = 1 AND permission_set_desc IN ('UNSAFE_ACCESS', 'EXTERNAL_ACCESS')"),
    Feature("4-3", "objects", "type IN ('P', 'FN', 'V') AND is_ms_shipped = 0"),
    Feature("4-4", "server_triggers", "TRUE"),
    Feature("4-5", "modules", "definition LIKE '%sp_configure%'"),
    Feature("4-6", "modules", "definition LIKE '%].dbo.%' OR definition LIKE '% AT [%'"),
    Feature("5-1", "databases", "is_published = 1"),
    Feature("5-2", "databases", "is_merge_published = 1"),
    Feature("5-3", "publications", "publication_type = 0"),
    Feature("5-4", "databases", "is_cdc_enabled = 1"),
    Feature("5-5", "change_tracking", "TRUE"),
    Feature("6-1", "databases", "is_broker_enabled = 1 AND database_id > 4"),
    Feature("6-2", "queues", "activation_procedure IS NOT NULL"),
    Feature("7-1", "fulltext_catalogs", "TRUE"),
    Feature("7-2", "filegroups", "type = 'FX'"),
    Feature("7-3", "user_tables", "temporal_type = 2"),
    Feature("7-4", "partition_functions", "TRUE"),
    Feature("7-5", "partitions", "data_compression > 0"),
    Feature("8-1", "principals", "type IN ('U', 'G') AND name NOT LIKE 'NT %'"),
    Feature("8-2", "sql_logins", "name NOT LIKE '##%'"),
    Feature("8-3", "databases", "is_encrypted = 1"),
    Feature("8-4", "column_keys", "TRUE"),
    Feature("8-5", "security_policies", "TRUE"),
]

# Syntax that no longer works at a higher compatibility level.
OLD_SYNTAX = [Feature("old-join", "modules", "definition LIKE '%*=%'"),
              Feature("group-by-all", "modules", "definition LIKE '%GROUP BY ALL%'")]

VM_ONLY = ("1-1", "1-2", "1-3", "1-4", "3-2", "4-2", "5-2", "6-2")
MI_AT_LEAST = ("2-1", "2-2", "2-3", "2-4", "3-1", "3-3", "4-1", "4-4", "4-6", "5-1", "6-1")

# Size limit of each target service in TB.
SIZE_LIMITS_TB = [("SQL Database GP", 4), ("SQL Database Hyperscale", 100), ("SQL MI GP", 16), ("SQL MI BC", 4)]
DEFAULT_COLLATION = "SQL_Latin1_General_CP1_CI_AS"


def findings(catalogs: dict[str, DataFrame], features: list[Feature] = FEATURES) -> DataFrame:
    """Rows (feature_id, db_name, object_name): one scan per extract for all of its checks."""
    parts = []
    for name in dict.fromkeys(f.catalog for f in features):
        if name not in catalogs:
            continue
        ids = F.array_compact(F.array(*[F.when(F.expr(f.predicate), F.lit(f.id)) for f in features if f.catalog == name]))
        parts.append(catalogs[name].select(F.explode(ids).alias("feature_id"), "db_name", F.col("name").alias("object_name")))
    return reduce(DataFrame.unionByName, parts)


def target_decision(found: DataFrame, answers: DataFrame) -> DataFrame:
    """Target service per database from its findings and the answers (oltp, read_only, big_or_rare)."""
    def any_of(ids):
        return F.max(F.col("feature_id").isin(*ids).cast("int"))
    flags = found.groupBy("db_name").agg(any_of(VM_ONLY).alias("vm"), any_of(MI_AT_LEAST).alias("mi"))
    j = answers.join(flags, "db_name", "left")
    return j.withColumn("target", F.when(F.col("vm") == 1, "SQL on VM").when(F.col("mi") == 1, "SQL MI")
                        .when(F.col("oltp"), "SQL DB Serverless")
                        .when(F.col("read_only") & F.col("big_or_rare"), "Synapse + ADLS").otherwise("SQL DB Serverless"))


def method_decision() -> Column:
    """Move method from size_gb, downtime_ok and read_only."""
    return F.when(F.col("read_only"), "Parquet export").when(
        (F.col("size_gb") < 200) & F.col("downtime_ok"), "BACPAC").otherwise("DMS")


def reconcile_counts(source: dict[str, DataFrame], copy: dict[str, DataFrame]) -> DataFrame:
    """Row counts of both sides per table and whether they agree; a missing table shows as NULL."""
    def counts(tables, name):
        parts = [df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(t).alias("table_name"), name) for t, df in tables.items()]
        return reduce(DataFrame.unionByName, parts)
    j = counts(source, "source_rows").join(counts(copy, "copy_rows"), "table_name", "full_outer")
    return j.withColumn("equal", F.coalesce(F.col("source_rows") == F.col("copy_rows"), F.lit(False)))


def reconcile_rows(source: DataFrame, copy: DataFrame, key: str) -> DataFrame:
    """Keys whose rows differ: missing, extra or changed. Only a digest of each key is shuffled.

    A NULL is told apart from every value and keeps its column. A key may repeat: the digests of all
    its rows are compared as a multiset, and the key is reported once. NULL keys are one key.
    """
    cols = [c for c in source.columns if c != key]
    marked = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]

    def digest(df, name):
        row = F.xxhash64(*marked) if marked else F.lit(0)
        return df.groupBy(key).agg(F.sum(row.cast("decimal(38,0)")).alias("total"), F.count(F.lit(1)).alias("n")) \
            .select(F.col(key).alias(f"{name}k"), F.struct("total", "n").alias(name))

    j = digest(source, "_s").join(digest(copy, "_c"), F.col("_sk").eqNullSafe(F.col("_ck")), "full_outer") \
        .withColumn(key, F.when(F.col("_s").isNull(), F.col("_ck")).otherwise(F.col("_sk")))
    status = F.when(F.col("_c").isNull(), "missing").when(F.col("_s").isNull(), "extra").when(F.col("_s") != F.col("_c"), "changed")
    return j.select(key, status.alias("status")).where(F.col("status").isNotNull())


RANGE_WIDTH = 1 << 16  # keys in a range; more widens what is read again for one difference
HASH_RANGES = 1 << 16  # parts of a key that is neither a number nor a date


def reconcile_ranges(source: DataFrame, copy: DataFrame, key: str, width: int = RANGE_WIDTH) -> DataFrame:
    """The rows of ``reconcile_rows``, found in two levels: a digest of each key range, then the keys of unequal ranges only.

    Equal copies cost one aggregate of each side, combined before the shuffle to a row a range. Numbers and dates are cut into ranges
    of ``width``, whose ends reach the scan as a filter on the key; other keys into parts by hash. Keys may repeat or be null.
    """
    kind = source.schema[key].dataType
    ordered = isinstance(kind, (IntegralType, DateType))
    number = F.unix_date(key) if isinstance(kind, DateType) else F.col(key)
    part = F.floor(number / F.lit(width)).cast("bigint") if isinstance(kind, DateType) else F.expr(f"(`{key}` - pmod(`{key}`, {width}L)) div {width}L")
    if not ordered:
        part = F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(HASH_RANGES)))
    marked = [x for c in source.columns for x in (F.col(c).isNull(), F.col(c))]

    def digest(df, name):
        g = df.groupBy(part.alias(f"_p{name}")).agg(F.sum(F.xxhash64(*marked).cast("decimal(38,0)")).alias("total"), F.count(F.lit(1)).alias("n"))
        return g.select(f"_p{name}", F.struct("total", "n").alias(f"_d{name}"))

    j = digest(source, "s").join(digest(copy, "c"), F.col("_ps").eqNullSafe(F.col("_pc")), "full_outer").where(~F.col("_ds").eqNullSafe(F.col("_dc")))
    path = shared_dir(source.sparkSession, "unequal-ranges")
    j.select(F.when(F.col("_ds").isNull(), F.col("_pc")).otherwise(F.col("_ps")).alias("_p")).write.parquet(path)
    unequal = source.sparkSession.read.schema("_p bigint").parquet(path)
    lo, hi, nulls, n = unequal.agg(F.min("_p"), F.max("_p"), F.count_if(F.col("_p").isNull()), F.count(F.lit(1))).first()
    if not n:
        return source.select(key, F.lit(None).cast("string").alias("status")).where(F.lit(False))

    def again(df):
        if ordered and lo is not None:
            ends = [F.lit(lo * width), F.lit(hi * width + width - 1)]
            if isinstance(kind, DateType):
                ends = [F.date_from_unix_date(e.cast("int")) for e in ends]
            inside = F.col(key).between(*ends)
            df = df.where(inside | F.col(key).isNull() if nulls else inside)
        return df.withColumn("_q", part).join(unequal, F.col("_q").eqNullSafe(F.col("_p")), "left_semi").drop("_q")

    return reconcile_rows(again(source), again(copy.select(*source.columns)), key)


def size_limit_check(sizes: DataFrame, limits: list[tuple[str, int]] = SIZE_LIMITS_TB) -> DataFrame:
    """Every database against the size limit of every target service."""
    lim = F.array(*[F.struct(F.lit(n).alias("service"), F.lit(tb).alias("limit_tb")) for n, tb in limits])
    x = sizes.select("*", F.explode(lim).alias("l")).select("db_name", "size_gb", "l.service", "l.limit_tb")
    return x.withColumn("fits", F.col("size_gb") <= F.col("limit_tb") * 1024)
