"""A CSV load that keeps going: rows that break the contract are put aside.

Every line is parsed once.  A line that is no record of the header's columns, a
value that is not of its column's type, and a row that breaks a named rule is
rejected with all its reasons; the rest is typed.  Both kinds are written in the
same pass, to the folders ``accepted=true`` and ``accepted=false`` of one table, so
that accepted and rejected rows together are the lines of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlab.sources.transactions import TRANSACTION_SCHEMA, read_text_columns

# rules of the transactions table: name -> condition that a row must not meet
TRANSACTION_RULES = {
    "no type": "type IS NULL",
    "negative amount": "amount < 0",
    "negative balance": "least(oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest) < 0",
    "label not 0 or 1": "isFraud IS NULL OR isFraud NOT IN (0, 1)",
}
_LINE, _REASONS = "rejected_line", "reasons"


def judge_rows(spark: SparkSession, path: str, schema: T.StructType = TRANSACTION_SCHEMA,
               rules: dict[str, str] = TRANSACTION_RULES) -> DataFrame:
    """The file's rows under ``schema`` with ``accepted``, ``reasons`` (none where
    accepted) and ``rejected_line`` (the row as it was read)."""
    names = read_text_columns(spark, path).columns  # the header
    missing = [c for c in schema.fieldNames() if c not in names]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _LINE]])
    rows = spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", _LINE).csv(path)

    def value(f: T.StructField) -> Column:
        return F.col(f"`{f.name}`").try_cast(f.dataType)

    bad_line = F.col(_LINE).isNotNull()
    types = [F.when(~bad_line & F.col(f"`{f.name}`").isNotNull() & value(f).isNull(),
                    F.lit(f"{f.name}: not {f.dataType.simpleString()}")) for f in schema.fields]
    as_read = F.coalesce(F.col(_LINE), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names])))
    typed = rows.select(*[F.when(~bad_line, value(f)).alias(f.name) for f in schema.fields], as_read.alias(_LINE),
                        F.array_compact(F.array(F.when(bad_line, F.lit("not a record of the header's columns")), *types))
                        .alias("_types"), bad_line.alias("_bad_line"))
    broken = [F.when(~F.col("_bad_line") & F.coalesce(F.expr(c), F.lit(False)), F.lit(r)) for r, c in rules.items()]
    judged = typed.withColumn(_REASONS, F.concat("_types", F.array_compact(F.array(*broken)) if broken else F.array()))
    ok = F.size(_REASONS) == 0
    return judged.select(*schema.fieldNames(), F.when(~ok, F.col(_LINE)).alias(_LINE), _REASONS, ok.alias("accepted"))


def load_with_quarantine(spark: SparkSession, path: str, out: str, schema: T.StructType = TRANSACTION_SCHEMA,
                         rules: dict[str, str] = TRANSACTION_RULES) -> str:
    """Read, judge and write in one pass."""
    judge_rows(spark, path, schema, rules).write.mode("overwrite").partitionBy("accepted").parquet(out)
    return out


def _stored(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(_LINE, T.StringType()),
                         T.StructField(_REASONS, T.ArrayType(T.StringType())), T.StructField("accepted", T.BooleanType())])
    return spark.read.schema(full).parquet(out)


def accepted_rows(spark: SparkSession, out: str, schema: T.StructType = TRANSACTION_SCHEMA) -> DataFrame:
    return _stored(spark, out, schema).filter("accepted").select(*schema.fieldNames())


def rejected_rows(spark: SparkSession, out: str, schema: T.StructType = TRANSACTION_SCHEMA) -> DataFrame:
    """``rejected_line, reasons``."""
    return _stored(spark, out, schema).filter("NOT accepted").select(_LINE, _REASONS)


def quarantine_report(spark: SparkSession, out: str, schema: T.StructType = TRANSACTION_SCHEMA) -> DataFrame:
    """``reason, rows``: rows accepted, rejected, and by each reason (a row may have
    several)."""
    rows = _stored(spark, out, schema)
    state = F.when(F.col("accepted"), "accepted").otherwise("rejected")
    each = F.explode(F.concat(F.array(state), F.col(_REASONS)))
    return rows.select(each.alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
