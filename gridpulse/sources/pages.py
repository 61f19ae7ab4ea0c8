"""Landed JSON pages of raw readings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.functions.columns import DATE_FORMAT
from gridpulse.operators.normalize import normalize_readings
from gridpulse.operators.windows import as_timestamp, within
from gridpulse.sources.files import Files

# Fields of one source row. ``value`` arrives as text or number
# and is read as text.
ROW_FIELDS = (
    "period",
    "respondent",
    "respondent-name",
    "type",
    "type-name",
    "value",
    "value-units",
)

# An ordinal is a number: the file's sequence number, the page in the file and
# the row in the page, the latter two at fixed widths.
_SEQUENCE_DIGITS = 22
_PAGE_DIGITS = 6
_ROW_DIGITS = 9

PAGE_SCHEMA = T.StructType(
    [
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField(
                        "data",
                        T.ArrayType(
                            T.StructType(
                                [T.StructField(n, T.StringType()) for n in ROW_FIELDS]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)

# Folder level of pages by the date of their readings, for pruned reads.
DATE_FOLDER = "date"


def read_pages(spark: SparkSession, path: str, number: str | None = None) -> DataFrame:
    """One row per reading, with ``ordinal``, over a folder of pages.

    A file holds one page or several, one per line or one after the other. The
    files' order is their sequence number: all digits of the path below ``path``,
    or the first group of the pattern ``number``. Numbers must differ from file
    to file and be padded to one width, otherwise there is no telling which
    reading comes first; a job over the file names checks that at once. A page
    without ``response.data`` fails the query that reads it.
    """
    root = Files(spark).raw_path(path)
    check_numbers(spark, [path], root, number)
    return explode_pages(_files(spark.read, path), root, number)


def stream_pages(spark: SparkSession, path: str, max_files: int = 1000, number: str | None = None) -> DataFrame:
    """S1 as a stream: each page is read once, when it has landed.

    ``max_files`` sizes the batches and has no influence on the stored result.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    return explode_pages(_files(reader, path), Files(spark).raw_path(path), number)


def page_source(spark: SparkSession, path: str, number: str | None = None) -> Callable[[object, object], DataFrame]:
    """A source over pages in folders ``date=YYYY-MM-DD`` of their readings' date.

    A window lists, checks and opens only the folders of its dates. Of the others
    nothing but the folder's name is read, one for each date of all history.
    """

    def read(start: object, end: object) -> DataFrame:
        folders = window_folders(spark, path, start, end)
        if not folders:
            kinds = [T.StructField(n, T.StringType()) for n in ROW_FIELDS]
            none = spark.createDataFrame([], T.StructType([*kinds, T.StructField("ordinal", T.DecimalType(38, 0))]))
            return within(normalize_readings(none), start, end)
        root = Files(spark).raw_path(path)
        check_numbers(spark, folders, root, number)
        files = spark.read.format("text").option("wholetext", True).option("basePath", path).load(folders)
        return within(normalize_readings(explode_pages(files, root, number)), start, end)

    return read


def window_folders(spark: SparkSession, path: str, start: object, end: object) -> list[str]:
    """The date folders that a window's readings can lie in, ascending."""
    bounds = [as_timestamp(b) if b is not None else F.lit(None) for b in (start, end)]
    low, high = spark.range(1).select(*[F.date_format(b, DATE_FORMAT) for b in bounds]).first()
    prefix = f"{DATE_FOLDER}="
    return [
        f"{path.rstrip('/')}/{name}"
        for name in Files(spark).names(path)
        if name.startswith(prefix) and (low or "") <= name.removeprefix(prefix) <= (high or "~")
    ]


def _files(reader, path: str) -> DataFrame:
    """Whole files as text; folders ``name=value`` below ``path`` are columns."""
    return reader.format("text").option("wholetext", True).load(path)


def _number_in(path: Column, root: str, number: str | None) -> Column:
    """The digits of a file's sequence number; empty if it has none."""
    folder = root.rstrip("/") + "/"
    at = F.locate(folder, path)
    below = F.when(at > 0, F.substr(path, at + len(folder))).otherwise(path)
    return F.regexp_replace(below, r"\D", "") if number is None else F.regexp_extract(below, number, 1)


def check_numbers(spark: SparkSession, paths: list[str], root: str, number: str | None = None) -> None:
    """Refuse file names that leave the order of readings open.

    The names are rows of Spark's file source, whose contents are not read; one
    aggregate by number counts ties, gaps in the numbering and widths.
    """
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path")
    numbers = names.groupBy(_number_in(F.col("path"), root, number).alias("number")).agg(F.count(F.lit(1)).alias("files"))
    found = numbers.agg(
        F.count_if(F.col("number") == "").alias("unnumbered"),
        F.count_if(F.col("files") > 1).alias("ties"),
        F.min(F.when(F.col("files") > 1, F.col("number"))).alias("tie"),
        F.min(F.length("number")).alias("narrowest"),
        F.max(F.length("number")).alias("widest"),
    ).first()
    if found["unnumbered"]:
        raise ValueError(f"Page files without number below {root}")
    if found["ties"]:
        raise ValueError(f"Page files below {root} share {found['ties']} number(s), the first is {found['tie']}")
    if found["narrowest"] != found["widest"]:
        raise ValueError(f"Numbers of page files below {root} have different widths: pad them with zeros")


# Control characters that no JSON text holds unescaped: they stand for an escaped
# quote, an escaped backslash and the end of a page while a file is split.
_QUOTE, _BACKSLASH, _PAGE_END = "\u0001", "\u0002", "\u001e"


def split_pages(text: Column) -> Column:
    """The pages of a file: JSON objects one after the other, with space between.

    A page ends where one brace closes and the next opens outside strings. Escaped
    backslashes and then escaped quotes are replaced first, so that every quote
    left begins or ends a string, and every second part between quotes is outside.
    A file with raw control characters is no JSON and stays whole.
    """
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    marked = F.transform(
        F.split(plain, '"'),
        lambda part, i: F.when(i % 2 == 0, F.regexp_replace(part, r"\}\s*\{", "}" + _PAGE_END + "{")).otherwise(part),
    )
    pages = F.transform(
        F.split(F.array_join(marked, '"'), _PAGE_END),
        lambda page: F.replace(F.replace(page, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\")),
    )
    return F.when(text.rlike(f"[{_QUOTE}{_BACKSLASH}{_PAGE_END}]"), F.array(text)).otherwise(pages)


def _failed(problem: Column, kind: T.DataType) -> Column:
    return F.raise_error(problem).cast(kind)


def explode_pages(files: DataFrame, root: str, number: str | None = None) -> DataFrame:
    """Files to rows. The ordinal is a decimal, which, unlike a string or a
    struct, keeps the aggregates that order by it hash aggregates."""
    path = F.col("_metadata.file_path")
    digits = _number_in(path, root, number)
    sequence = F.when(
        (digits == "") | (F.length(digits) > _SEQUENCE_DIGITS),
        _failed(F.concat(F.lit("Page file without number, or one too long: "), path), T.StringType()),
    ).otherwise(digits)
    pages = files.select(
        sequence.alias("sequence"), path.alias("path"), F.posexplode(split_pages(F.col("value"))).alias("page", "text")
    )
    rows = F.from_json("text", PAGE_SCHEMA)["response"]["data"]
    kind = PAGE_SCHEMA["response"].dataType["data"].dataType
    data = F.when(
        rows.isNull(), _failed(F.concat(F.lit("Page without response.data: "), "path"), kind)
    ).otherwise(rows)
    place = F.concat(
        "sequence",
        F.lpad(F.col("page").cast("string"), _PAGE_DIGITS, "0"),
        F.lpad(F.col("position").cast("string"), _ROW_DIGITS, "0"),
    )
    return pages.select("sequence", "page", F.posexplode(data).alias("position", "row")).select(
        "row.*", place.cast("decimal(38,0)").alias("ordinal")
    )
