"""The transactions table.

The production input is one headered CSV (or a parquet copy of it) read under a
pinned schema -- no inference pass.  For the test tables shipped with the
repository the same eleven columns are derived from ``lineitem``, ``orders``,
``customer`` and ``supplier`` (``transactions_from_tables``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlab import config as C

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("step", T.IntegerType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("amount", T.DoubleType(), True),
        T.StructField("nameOrig", T.StringType(), True),
        T.StructField("oldbalanceOrg", T.DoubleType(), True),
        T.StructField("newbalanceOrig", T.DoubleType(), True),
        T.StructField("nameDest", T.StringType(), True),
        T.StructField("oldbalanceDest", T.DoubleType(), True),
        T.StructField("newbalanceDest", T.DoubleType(), True),
        T.StructField("isFraud", T.IntegerType(), True),
        T.StructField("isFlaggedFraud", T.IntegerType(), True),
    ]
)

KEYED_SCHEMA = T.StructType([T.StructField(C.KEY, T.StringType(), True)] + TRANSACTION_SCHEMA.fields)


def read_text_columns(spark: SparkSession, path: str) -> DataFrame:
    """A headered CSV with every column as text, named by its header: the input
    of ``contract_report``."""
    return spark.read.option("header", True).option("mode", "FAILFAST").csv(path)


def read_transactions(spark: SparkSession, path: str, fmt: str = "csv", keyed: bool = False) -> DataFrame:
    """Read a transactions file under the pinned schema (no inference pass).

    CSV columns are bound by the header's names, in whatever order they stand;
    a missing column or a value of another type is an error.
    """
    schema = KEYED_SCHEMA if keyed else TRANSACTION_SCHEMA
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    text = read_text_columns(spark, path)
    missing = [c for c in schema.fieldNames() if c not in text.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    # cast() fails on a bad value under ANSI mode; without it the cast would be null
    def typed(f):
        x = F.col(f"`{f.name}`")
        bad = x.isNotNull() & x.try_cast(f.dataType).isNull()
        message = F.concat(F.lit(f"{f.name}: not {f.dataType.simpleString()}: "), x)
        return F.when(bad, F.raise_error(message)).otherwise(x.try_cast(f.dataType)).cast(f.dataType).alias(f.name)

    return text.select(*[typed(f) for f in schema.fields])


def add_row_key(df: DataFrame, key: str = C.KEY, cols=None) -> DataFrame:
    """Add a repeatable row key (sha-256 of the row's values) when the input
    has none: identical rows share it, so they land in the same split."""
    if key in df.columns:
        return df
    cols = list(cols or [c for c in C.TRANSACTION_COLUMNS if c in df.columns] or df.columns)
    return df.withColumn(key, F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]), 256))


def write_transactions(df: DataFrame, path: str, partition_by=("type",), fmt: str = "parquet") -> str:
    """Store a transactions table once, partitioned by ``type``.

    Later reads that keep some types (P1) then prune whole partitions at the
    scan (``PartitionFilters``) instead of filtering rows; a type holding a
    third of all rows is still read in file splits of
    ``spark.sql.files.maxPartitionBytes``, so it is not one task.
    """
    df.write.mode("overwrite").partitionBy(*partition_by).format(fmt).save(path)
    return path


def read_stored_transactions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a table written by ``write_transactions`` (schema from the files,
    columns in the contract's order)."""
    df = spark.read.format(fmt).load(path)
    order = [c for c in KEYED_SCHEMA.fieldNames() if c in df.columns]
    return df.select(*order)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# fixed values: mapping from order priority to transaction type
PRIORITY_TO_TYPE = (
    ("1-URGENT", "TRANSFER"),
    ("2-HIGH", "CASH_OUT"),
    ("3-MEDIUM", "PAYMENT"),
    ("4-NOT SPECIFIED", "CASH_IN"),
)
EPOCH_1995 = "1995-01-01 00:00:00"


def _type_of(priority: Column) -> Column:
    expr = None
    for prio, typ in PRIORITY_TO_TYPE:
        expr = (F.when(priority == prio, typ) if expr is None else expr.when(priority == prio, typ))
    return expr.otherwise("DEBIT")


def transactions_from_tables(spark: SparkSession, sf_dir: str, types=None) -> DataFrame:
    """The eleven transaction columns (plus ``txn_key``) over the driver tables.

    With ``types`` only those are kept, by a filter on the order priority that
    reaches the scan of ``orders``.

    Join order is chosen for scale: ``supplier`` is joined to ``lineitem`` on
    its own key (Spark broadcasts it only if its measured size is under the
    broadcast threshold), ``orders`` is joined to ``customer`` before it meets
    ``lineitem``, so the widest table is shuffled once, on ``l_orderkey``.
    Skewed join keys are split by AQE's skew-join handling.
    """
    li = load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    kept = [p for p, t in PRIORITY_TO_TYPE if types is not None and t in types]
    if types is not None and "DEBIT" not in types:  # DEBIT is every other priority
        orders = orders.filter(F.col("o_orderpriority").isin(*kept))
    customer = load_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    supplier = load_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")

    oc = orders.join(customer, orders.o_custkey == customer.c_custkey)
    ls = li.join(supplier, li.l_suppkey == supplier.s_suppkey)
    j = ls.join(oc, ls.l_orderkey == oc.o_orderkey)

    bal_orig = F.col("c_acctbal") * F.lit(10.0)
    bal_dest = F.col("s_acctbal") * F.lit(10.0)
    amount = F.col("l_extendedprice")
    prio = F.col("o_orderpriority")
    step = F.expr(
        f"CAST(timestampdiff(HOUR, TIMESTAMP_NTZ '{EPOCH_1995}', CAST(l_shipdate AS TIMESTAMP_NTZ)) AS INT)"
    )
    fraud = (
        prio.isin("1-URGENT", "2-HIGH")
        & (amount >= 70000)
        & (bal_orig <= amount)
        & (F.col("l_returnflag") == "R")
        & (F.col("l_tax") >= 0.06)
    )
    flagged = (prio == "1-URGENT") & (amount > 90000)
    return j.select(
        F.concat_ws(
            "|",
            F.col("l_orderkey").cast("string"),
            F.col("l_linenumber").cast("string"),
            F.col("l_partkey").cast("string"),
            F.col("l_suppkey").cast("string"),
        ).alias(C.KEY),
        step.alias("step"),
        _type_of(prio).alias("type"),
        amount.alias("amount"),
        F.col("c_name").alias("nameOrig"),
        bal_orig.alias("oldbalanceOrg"),
        F.greatest(bal_orig - amount, F.lit(0.0)).alias("newbalanceOrig"),
        F.col("s_name").alias("nameDest"),
        bal_dest.alias("oldbalanceDest"),
        F.when(F.col("l_linestatus") == "F", bal_dest + amount).otherwise(bal_dest).alias("newbalanceDest"),
        fraud.cast("int").alias("isFraud"),
        flagged.cast("int").alias("isFlaggedFraud"),
    )
