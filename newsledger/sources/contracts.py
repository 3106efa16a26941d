"""Table contracts: declared schemas, required / optional columns, and the
CSV readers of the URL and article tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

URL_TABLE = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("context", T.StringType()),
    T.StructField("is_news", T.IntegerType()),
])
ARTICLE_TABLE = T.StructType(URL_TABLE.fields + [
    T.StructField("content", T.StringType()),
    T.StructField("scrape_status", T.StringType()),
])
LINK_TABLE = T.StructType([
    T.StructField("link", T.StringType()),
    T.StructField("added_at_utc", T.TimestampType()),
])
LABEL_RESULTS = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("is_news", T.IntegerType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("method_used", T.StringType()),
    T.StructField("fallback_triggered", T.BooleanType()),
    T.StructField("error_details", T.StringType()),
])

ARTICLE_REQUIRED = ("url", "content", "scrape_status")
URL_REQUIRED = ("url",)
# Accepted spellings of the URL column, in order.
URL_ALIASES = ("URL", "Url", "link", "Link", "href", "Href")


class ContractError(ValueError):
    pass


def require_columns(df: DataFrame, required) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ContractError(f"missing required columns: {missing}")
    return df


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add absent schema columns as typed nulls and cast present ones."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [F.col(f"`{c}`") for c in df.columns if c not in schema.fieldNames()]
    return df.select(*cols, *extra)


def resolve_url_column(df: DataFrame, aliases=URL_ALIASES) -> DataFrame:
    """Rename the first URL-like column to ``url``; error when there is none."""
    if "url" in df.columns:
        return df
    for a in aliases:
        if a in df.columns:
            return df.withColumnRenamed(a, "url")
    raise ContractError("no URL-like column found (expected url/link/href)")


def _csv(spark: SparkSession, encoding: str, multiline: bool):
    return (spark.read.option("header", True).option("multiLine", multiline).option("quote", '"')
            .option("escape", '"').option("mode", "PERMISSIVE").option("encoding", encoding))


def files_of(spark: SparkSession, path: str) -> list[str]:
    """Data files behind a path, folder or glob on any file system Spark reads
    (file names only; none if nothing is there)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for found in fs.globStatus(p) or []:
        inner = fs.listStatus(found.getPath()) if found.isDirectory() else [found]
        out += [f.getPath().toString() for f in inner if f.isFile() and f.getPath().getName()[0] not in "._"]
    return sorted(out)


def not_utf8(spark: SparkSession, files: list[str]) -> list[str]:
    """The files with a line that is not valid UTF-8: one distributed scan,
    reduced to file names."""
    from urllib.parse import unquote
    rows = spark.read.text(files).select(F.input_file_name().alias("f"), "value")
    bad = {unquote(r["f"]) for r in rows.where(~F.is_valid_utf8("value")).select("f").distinct().collect()}
    plain = {f: f.split(":", 1)[-1].lstrip("/") for f in files}
    ends = {b.split(":", 1)[-1].lstrip("/") for b in bad}
    return [f for f in files if plain[f] in ends]


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType, required=(),
                   encoding: str | None = None, multiline: bool = True) -> DataFrame:
    """Read CSV files under a contract: header names checked against ``required``,
    known columns typed from ``schema`` (never inferred), optional ones added.
    Without ``encoding`` each file is UTF-8, or latin-1 if it is not valid
    UTF-8. ``multiline`` off lets Spark split large files that have no line
    breaks inside values."""
    files = files_of(spark, path)
    if not files:
        raise ContractError(f"no such table: {path}")
    if encoding:
        groups = [(encoding, files)]
    else:
        latin = set(not_utf8(spark, files))
        groups = [("UTF-8", [f for f in files if f not in latin]), ("iso-8859-1", [f for f in files if f in latin])]
    out = None
    for enc, part in groups:
        if not part:
            continue
        header = _csv(spark, enc, multiline).csv(part).columns   # reads the header line only
        if not header:
            raise ContractError(f"empty table: {path}")
        present = T.StructType([next((f for f in schema.fields if f.name == h), T.StructField(h, T.StringType()))
                                for h in header])
        df = ensure_columns(require_columns(_csv(spark, enc, multiline).schema(present).csv(part), required), schema)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_article_table(spark: SparkSession, path: str, **kw) -> DataFrame:
    return read_csv_table(spark, path, ARTICLE_TABLE, ARTICLE_REQUIRED, **kw)


def read_url_table(spark: SparkSession, path: str | None, **kw) -> DataFrame:
    """URL table; an empty typed table when nothing is at the path."""
    if path is None or not files_of(spark, path):
        return spark.createDataFrame([], URL_TABLE)
    return read_csv_table(spark, path, URL_TABLE, URL_REQUIRED, **kw)
