"""The driver's tables as long hourly readings.

The engine reads ``(period, respondent, respondent_name, type, value)``; no
driver table has that shape, so two adapters derive it. The value rules put
unparsable text, nulls, zeros and negatives among the readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.columns import HOUR_FORMAT
from gridpulse.session import prepare_session

PAGE_NUMBER = r"page=(\d+)"

# Metric code per event type; other events become ``XX``.
EVENT_METRICS = {"view": "D", "click": "DF", "purchase": "NG", "signup": "TI"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare_session(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as readings; ``event_id`` is the row order."""
    event = F.col("event_id")
    code = F.lit("XX")
    for event_type, metric in EVENT_METRICS.items():
        code = F.when(F.col("event_type") == event_type, metric).otherwise(code)
    negative = (event % 19 == 0) | (
        (F.col("event_type") == "signup") & (event % 2 == 0)
    )
    value = (
        F.when(event % 101 == 0, "n/a")
        .when(event % 13 == 0, F.lit(None))
        .when(event % 17 == 0, "0")
        .when(negative, (-F.col("value")).cast("string"))
        .otherwise(F.col("value").cast("string"))
    )
    region = (F.col("user_id") % 4).cast("string")
    return table(spark, sf_dir, "events").select(
        F.date_format("ts", HOUR_FORMAT).alias("period"),
        F.concat(F.lit("R"), region).alias("respondent"),
        F.when(event % 11 != 0, F.concat(F.lit("Region "), region)).alias(
            "respondent-name"
        ),
        code.alias("type"),
        value.alias("value"),
        event.alias("ordinal"),
    )


def nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(respondent, respondent_name) of ``lineitem_readings``."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("respondent"),
        F.col("n_name").alias("respondent_name"),
    )


def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as readings: four metrics per hour and supplier nation.

    The terms have four decimals at most and are summed as whole
    ten-thousandths, so the sums do not depend on row order and the buffers
    stay eight bytes wide. The metrics are spread over rows only after the
    aggregation.
    """
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    terms = {
        "D": price,
        "DF": price * (1 - discount + tax),
        "NG": F.col("l_quantity") * 1000,
        "TI": price * (discount - tax),
    }
    hour = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 24
    period = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(
        F.lit(0), hour.cast("int")
    )
    scale = 10_000

    def total(term: Column) -> Column:
        return F.sum(F.rint(term * scale).cast("bigint"))

    cells = (
        table(spark, sf_dir, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(period.alias("period"), "s_nationkey")
        .agg(*[total(term).alias(metric) for metric, term in terms.items()])
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    readings = F.array(
        *[
            F.struct(F.lit(m).alias("type"), (F.col(m) / scale).alias("value"))
            for m in terms
        ]
    )
    return cells.select(
        "period",
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("respondent"),
        F.col("n_name").alias("respondent_name"),
        F.inline(readings),
    )


def _page_text(readings: DataFrame, *page: Column) -> DataFrame:
    """Readings as JSON pages, of consecutive rows by ``ordinal``."""
    fields = [F.col(f"`{name}`") for name in readings.columns if name not in ("ordinal", "_file", "_page")]
    rows = F.collect_list(F.struct("ordinal", F.struct(*fields).alias("row")))
    pages = readings.groupBy(*page).agg(F.sort_array(rows).alias("rows"))
    data = F.transform("rows", lambda item: item["row"])
    return pages.withColumn("value", F.to_json(F.struct(F.struct(data.alias("data")).alias("response"))))


def land_pages(readings: DataFrame, folder: str, rows_per_page: int, pages_per_file: int = 1) -> None:
    """Readings as JSON pages below ``folder``, dealt to two folders in turn.

    A file has ``pages_per_file`` consecutive pages, one after the other; its number
    is in its path, where ``PAGE_NUMBER`` finds it. Rows are shuffled once, by file.
    """
    page = F.floor(F.col("ordinal") / rows_per_page)
    file = F.floor(F.col("ordinal") / (rows_per_page * pages_per_file))
    together = readings.withColumns({"_file": file, "_page": page}).repartition("_file")
    pages = _page_text(together, F.col("_file"), F.col("_page"))
    files = pages.groupBy("_file").agg(F.sort_array(F.collect_list(F.struct("_page", "value"))).alias("pages"))
    (
        files.select(
            F.array_join(F.transform("pages", lambda p: p["value"]), " ").alias("value"),
            F.pmod("_file", F.lit(2)).alias("landed"),
            F.lpad(F.col("_file").cast("string"), 12, "0").alias("page"),
        )
        .write.partitionBy("landed", "page")
        .text(folder)
    )


def land_dated_pages(readings: DataFrame, folder: str, rows_per_page: int) -> None:
    """Readings as JSON pages in folders of their date, several pages to a file.

    A file has the pages of one date whose numbers share all but the last digit,
    one after the other; it is numbered by its first row's ordinal.
    """
    number = F.floor(F.col("ordinal") / rows_per_page)
    pages = _page_text(readings, F.substring("period", 1, 10).alias("date"), number.alias("number"))
    files = pages.groupBy("date", F.floor(F.col("number") / 10).alias("tens")).agg(
        F.sort_array(F.collect_list(F.struct("number", "value"))).alias("pages"), F.min(F.col("rows")[0]["ordinal"]).alias("first")
    )
    (
        files.select(
            F.array_join(F.transform("pages", lambda p: p["value"]), " ").alias("value"),
            "date",
            F.lpad(F.col("first").cast("string"), 12, "0").alias("page"),
        )
        .write.partitionBy("date", "page")
        .text(folder)
    )
