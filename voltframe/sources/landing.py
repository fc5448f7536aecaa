"""Landed API responses -> typed series.

HTTP fetching, paging and login are not rebuilt: responses are landed as JSON
files (one response or page per line) and read in one distributed scan with an
explicit schema, or parsed from a string column already in a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.columns import lenient_double, parse_utc
from voltframe.operators.dedupe import dedupe_first
from voltframe.operators.sequence import join_keys

EMISSIONS_RESPONSE = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("point_time", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]))),
    T.StructField("region", T.StringType()),
])

DEMAND_PAGE = T.StructType([
    T.StructField("response", T.StructType([
        T.StructField("data", T.ArrayType(T.StructType([
            T.StructField("period", T.StringType()),
            T.StructField("respondent", T.StringType()),
            T.StructField("type", T.StringType()),
            T.StructField("value", T.StringType()),
        ]))),
    ])),
])


def bad_responses(df: DataFrame, schema: T.StructType, json_col: str = "body") -> DataFrame:
    """The rows whose body gives no data: malformed JSON, an error body, or no ``data`` array.
    Adds ``reason``; the rows that the parsers use are exactly the others."""
    kept = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(F.col(json_col), kept, {"columnNameOfCorruptRecord": "_corrupt"})
    data = F.col("_b.response.data") if "response" in schema.fieldNames() else F.col("_b.data")
    reason = (F.when(F.col(json_col).isNull(), "empty").when(F.col("_b._corrupt").isNotNull() | F.col("_b").isNull(), "malformed")
              .when(data.isNull(), "no data"))
    return df.withColumn("_b", parsed).withColumn("reason", reason).where("reason IS NOT NULL").drop("_b")


def nan_to_null(df: DataFrame, columns) -> DataFrame:
    """NaN -> NULL (Spark orders NaN above every number; pandas compares it false)."""
    return df.withColumns({c: F.when(F.isnan(F.col(c)), F.lit(None).cast("double")).otherwise(F.col(c))
                           for c in columns})


def _emissions_rows(parsed: DataFrame, region: str | None) -> DataFrame:
    cols = [c for c in parsed.columns if c != "_r"]
    d = parsed.select(*cols, F.col("_r.region").alias("_region"), F.inline(F.col("_r.data")))
    reg = F.lit(region) if region is not None else F.col("_region")
    d = d.select(*cols, parse_utc("point_time").alias("timestamp"), reg.alias("region"),
                 F.col("value").cast("double").alias("value"))
    return nan_to_null(d, ["value"])


def parse_emissions_responses(df: DataFrame, json_col: str = "body", region: str | None = None) -> DataFrame:
    """S1 from a string column: each row one response ``{"data": [{point_time, value}, ...]}``.

    Other columns of ``df`` are carried to every data row. ``region`` tags the
    rows (otherwise the response's own ``region`` field is used).
    """
    parsed = df.withColumn("_r", F.from_json(F.col(json_col), EMISSIONS_RESPONSE)).drop(json_col)
    return _emissions_rows(parsed, region)


def read_emissions_landing(spark: SparkSession, path: str, region: str | None = None) -> DataFrame:
    """S1 from landed response files (JSON lines, schema given, never inferred)."""
    raw = spark.read.schema(EMISSIONS_RESPONSE).json(path)
    return _emissions_rows(raw.select(F.struct(*raw.columns).alias("_r")), region)


def _demand_rows(parsed: DataFrame, respondent: str | None, type_code: str) -> DataFrame:
    cols = [c for c in parsed.columns if c != "_p"]
    d = parsed.select(*cols, F.inline(F.col("_p.response.data")))
    d = d.where(F.col("type") == F.lit(type_code))
    if respondent is not None:
        d = d.where(F.col("respondent") == F.lit(respondent))
    return d


def parse_demand_pages(df: DataFrame, json_col: str = "body", respondent: str | None = None,
                       type_code: str = "D") -> DataFrame:
    """S2 from a string column: each row one page ``{"response": {"data": [...]}}``.

    Rows of every page are appended (no de-duplication across pages), keeping the
    requested type and respondent. Output keeps the raw text fields
    ``period, respondent, type, value``; ``process_demand`` types them.
    """
    parsed = df.withColumn("_p", F.from_json(F.col(json_col), DEMAND_PAGE)).drop(json_col)
    return _demand_rows(parsed, respondent, type_code)


def read_demand_pages(spark: SparkSession, path: str, respondent: str | None = None,
                      type_code: str = "D") -> DataFrame:
    """S2 from a directory of landed page files, read in one scan."""
    raw = spark.read.schema(DEMAND_PAGE).json(path)
    return _demand_rows(raw.select(F.struct(*raw.columns).alias("_p")), respondent, type_code)


def follow_pages(pages: DataFrame, *, keys: Sequence[str], page: str, json_col: str = "body",
                 page_size: int = 5000) -> DataFrame:
    """S2's paging rule over landed pages: pages of one request (``keys``) are used in order of ``page``
    up to the first that is failed, empty or short; a short last page is used, what lies behind is not.

    Adds ``n_records`` (NULL for a failed body), ``status`` (``full``, ``short``, ``empty``, ``failed``)
    and ``used``; pages behind the end keep their status and are reported with ``used`` false.
    A page that landed several times counts once (the smallest body). The end per request
    is a distributed minimum; no request's pages are held in one task.
    """
    keys = list(keys)
    once = dedupe_first(pages.select(*keys, page, json_col), [*keys, page], [json_col])
    n = F.size(F.from_json(F.col(json_col), DEMAND_PAGE)["response"]["data"])
    d = once.withColumn("n_records", F.when(n >= 0, n))
    d = d.withColumn("status", F.when(F.col("n_records").isNull(), "failed").when(F.col("n_records") == 0, "empty")
                     .when(F.col("n_records") < page_size, "short").otherwise("full"))
    ends = d.where("status <> 'full'").groupBy(*keys).agg(F.min(page).alias("_end"))
    d = join_keys(d, ends, keys, "left")
    used = F.col("_end").isNull() | (F.col(page) < F.col("_end")) | ((F.col(page) == F.col("_end")) & (F.col("status") == "short"))
    return d.withColumn("used", F.coalesce(used, F.lit(False))).drop("_end")


def rename_if_present(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename only the columns that exist."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def process_demand(df: DataFrame, keep: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """``strict``: a period that is no time is an error, as in the source pipeline; else it becomes
    a NULL time (count them before a resampling step drops them). P1: ``period -> timestamp`` (UTC), ``value -> demand_MW`` (lenient numeric),
    ``respondent -> balancing_authority``; keeps those three plus ``keep``."""
    d = rename_if_present(df, {"period": "timestamp", "value": "demand_MW",
                               "respondent": "balancing_authority"})
    d = d.withColumns({"timestamp": parse_utc("timestamp", strict=strict), "demand_MW": lenient_double("demand_MW")})
    d = nan_to_null(d, ["demand_MW"])
    return d.select("timestamp", "balancing_authority", "demand_MW", *keep)
