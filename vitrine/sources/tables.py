"""The history table: typed load, load modes, publication."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.functions.text import as_text
from vitrine.functions.urls import canonical_retailer
from vitrine.sources.snapshot import final_columns

INTEGER_COLUMNS = ("main_rank", "bsr_rank")
# account_key, product: partitions of the table, so a slice replace rewrites one folder
PARTITIONS = ("account_key", "product")
KEY_COLUMNS = ("account_key", "item_key")


def typed_load(df: DataFrame, int_columns=INTEGER_COLUMNS) -> DataFrame:
    """Blank to NULL, rank columns to integer (bad ones NULL), the rest trimmed text."""
    def typed(c: str) -> Column:
        text = F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
        if c not in int_columns:
            return text.alias(c)
        whole = F.when(text.rlike(r"^[+-]?\d+$"), text)
        return whole.try_cast("int").alias(c)

    return df.select(*[typed(c) for c in df.columns])


def with_keys(df: DataFrame) -> DataFrame:
    """Canonical key columns, so that later reads filter on plain columns."""
    return df.withColumns({
        "account_key": F.coalesce(F.nullif(canonical_retailer(F.col("account_name")), F.lit("")), F.lit("other")),
        "item_key": F.lower(F.trim(as_text(F.col("item")))),
        "product": F.upper(F.trim(as_text(F.col("product")))),
        "loaded_at": F.current_timestamp(),
        "row_id": F.expr("uuid()"),
    })


def output_table(line: str, overrides: dict[str, str] | None = None, pattern: str = "{line}_retail_com") -> str:
    """Table a line is loaded into; an explicit override wins."""
    key = line.strip().upper()
    return (overrides or {}).get(key) or pattern.format(line=key.lower())


def table_schema(line: str) -> T.StructType:
    fields = [
        T.StructField(c, T.IntegerType() if c in INTEGER_COLUMNS else T.StringType())
        for c in final_columns(line) if c != "product"
    ]
    extra = [T.StructField("item_key", T.StringType()), T.StructField("loaded_at", T.TimestampType()),
             T.StructField("row_id", T.StringType()), T.StructField("account_key", T.StringType()),
             T.StructField("product", T.StringType())]
    return T.StructType(fields + extra)


def prepare_table(spark: SparkSession, table: str, line: str) -> None:
    """Create the table with typed columns and load time unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table_schema(line))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITIONS)})"
    )


def load(df: DataFrame, table: str, line: str, mode: str = "append",
         retailer: str | None = None) -> dict:
    """Load published rows; returns the mode and the number of inserted rows.

    append adds; replace_slice overwrites only the (account, line) partitions present in
    ``df`` in one commit, other slices stay; overwrite replaces the whole table.
    """
    if mode not in ("append", "replace_slice", "overwrite"):
        raise ValueError(f"unknown load mode: {mode}")
    spark = df.sparkSession
    schema = table_schema(line)
    seen = Observation(f"load_{uuid.uuid4().hex}")
    typed = with_keys(typed_load(df.select(*final_columns(line))))
    if mode == "replace_slice":
        wanted = line.strip().upper()
        if retailer is None:
            raise ValueError("replace_slice needs the retailer of the slice")
        typed = typed.filter((F.col("account_key") == retailer) & (F.col("product") == wanted))
    rows = typed.select(*[F.col(f.name).cast(f.dataType) for f in schema]).observe(
        seen, F.count(F.lit(1)).alias("inserted"))
    # one file group per slice; AQE splits or merges it by size
    writer = rows.repartition(*PARTITIONS, F.pmod(F.xxhash64("item_key"), F.lit(64))).write
    if mode == "append":
        writer.mode("append").insertInto(table)
    else:
        # insertInto takes no such option, so the session's setting is switched for this one write
        before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic" if mode == "replace_slice" else "static")
        try:
            writer.mode("overwrite").insertInto(table)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    return {"mode": mode, "inserted": int(seen.get["inserted"])}


def replaced_slice(existing: DataFrame, new: DataFrame, account_key: str, line: str) -> DataFrame:
    """Content of the table after a slice replace, as a plan (for checks and staging)."""
    account = canonical_retailer(F.col("account_name"))
    product = F.upper(F.trim(as_text(F.col("product"))))
    keep = ~((account == account_key) & (product == line))
    return existing.filter(keep).unionByName(new)


# ---- publish gate -------------------------------------------------------------------------------


def content_hash(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Order-free content hash per run: row count and sum of the rows' 64-bit hashes."""
    row = F.xxhash64(*[as_text(F.col(c)) for c in columns]).cast("decimal(38,0)")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum(row).alias("content"))


def publish_gate(target: DataFrame, product: DataFrame, manifest: DataFrame, keys: list[str],
                 position: str = "position") -> DataFrame:
    """Why a run may not be published ('' when it may).

    manifest: complete (bool), expected_rows, target_content (hash of the target rows).
    """
    from vitrine.operators.merge import compare_positions

    compared = compare_positions(target, product, keys, ["item", "product_url"], position)
    hashed = content_hash(target, keys, ["item", "product_url", position]).select(
        *keys, F.col("content").alias("actual_content"))
    reason = (
        F.when(~F.coalesce("complete", F.lit(False)), "incomplete")
        .when(F.coalesce("actual_rows", F.lit(0)) != F.col("expected_rows_declared"), "product_rows")
        .when(~F.col("target_content").eqNullSafe(F.col("actual_content")), "target_hash_mismatch")
        .when(F.coalesce("expected_rows", F.lit(0)) != F.col("expected_rows_declared"), "target_rows")
        .when(F.col("first_mismatch").isNotNull(), "product_identity")
        .otherwise("")
    )
    return (
        manifest.withColumnRenamed("expected_rows", "expected_rows_declared")
        .join(compared.drop("error"), keys, "left").join(hashed, keys, "left")
        .select(*keys, reason.alias("reason"), F.col("first_mismatch"))
    )


def publish(df: DataFrame, folder: str, accepted) -> bool:
    """Write a version of its own below ``folder``, check what was written, then point at it.

    ``accepted`` gets the re-read version and says whether it may go live.  Versions are never changed or moved, and the pointer
    is one small file that a rename replaces as a whole, so a reader (:func:`published`) sees the old version or
    the new one, also while it is being switched.  Versions that nobody reads any more are left to the folder's owner.
    """
    spark = df.sparkSession
    version = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/{version}")
    if not accepted(spark.read.parquet(f"{folder}/{version}")):
        return False
    _replace_text(spark, f"{folder}/{POINTER}", version)
    return True


#: the file of a published folder that names its live version
POINTER = "_CURRENT"


def published(spark: SparkSession, folder: str) -> DataFrame | None:
    """The live version of a published folder, None if there is none yet."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{POINTER}")
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        version = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return spark.read.parquet(f"{folder}/{version}")


def _replace_text(spark: SparkSession, target: str, text: str) -> None:
    """Write a small file beside its target and rename it over the target in one step."""
    gateway = spark.sparkContext._gateway
    jvm, conf = gateway.jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{target}.{uuid.uuid4().hex}", target))
    out = new.getFileSystem(conf).create(new)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    how = gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri(), conf).rename(new, old, how)
