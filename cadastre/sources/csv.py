"""S8 read_registry_csv and S10 shape_rows.

The files are ``;``-separated, ``"``-quoted, ISO-8859-1, without header;
rows may be ragged.  An explicit all-string schema binds fields by position:
short rows get a NULL tail and surplus fields are dropped (S10), so no
per-row Python is needed.  Reader options (probed on Spark 4.1):

* ``escape='"'`` — doubled quotes inside a quoted field;
* ``unescapedQuoteHandling='STOP_AT_CLOSING_QUOTE'`` — lazy quotes;
* ``multiLine`` — quoted newlines; it disables splitting inside one file.
  ``multi_line="auto"`` decides for each file: one that is a single split anyway
  is read whole at once; a larger one is first scanned (in splits) for a line
  with an odd number of quotes, and only a file that has one stays unsplit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import sanitize
from ..schema import TableSpec

CSV_OPTIONS = {
    "sep": ";",
    "quote": '"',
    "escape": '"',
    "encoding": "ISO-8859-1",
    "header": "false",
    "mode": "PERMISSIVE",
    "unescapedQuoteHandling": "STOP_AT_CLOSING_QUOTE",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def quoted_newline_files(spark: SparkSession, paths: list[str]) -> set[str]:
    """Files in which some physical line holds an odd number of quote characters
    — the only way a field can continue on the next line.  A splittable text
    scan and one flag a file; quotes are ASCII, so the Latin-1 bytes need no
    decoding for this."""
    v = F.col("value")
    odd = F.pmod(F.length(v) - F.length(F.replace(v, F.lit('"'), F.lit(""))), F.lit(2)) == 1
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), odd.alias("odd"))
    return {r["file"] for r in lines.where("odd").select("file").distinct().collect()}


def has_quoted_newlines(spark: SparkSession, paths) -> bool:
    return bool(quoted_newline_files(spark, [paths] if isinstance(paths, str) else list(paths)))


def _unsplit(spark: SparkSession, paths: list[str]) -> tuple[list[str], list[str]]:
    """The paths to read whole, and those that may be split."""
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    conf, hadoop = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    whole, large = [], []
    for p in paths:
        path = hadoop(p)
        status = path.getFileSystem(conf).getFileStatus(path)
        (whole if status.isFile() and status.getLen() <= split else large).append(p)
    odd = quoted_newline_files(spark, large) if large else set()
    plain = lambda f: f.split("://")[-1].removeprefix("file:").lstrip("/")
    found = {plain(f) for f in odd}
    holds = lambda p: any(f == plain(p) or f.startswith(plain(p).rstrip("/") + "/") for f in found)
    return whole + [p for p in large if holds(p)], [p for p in large if not holds(p)]


def read_registry_csv(spark: SparkSession, paths, spec: TableSpec, multi_line: bool | str = True) -> DataFrame:
    """Raw positional strings of ``spec`` plus ``_file`` and ``_ord`` (file order).

    ``_ord`` = (block start, monotonically increasing id) taken right after the
    scan, before any shuffle: inside a file it follows the file's row order,
    which U1 needs for "first row wins".
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    whole, split = _unsplit(spark, paths) if multi_line == "auto" else (paths, []) if multi_line else ([], paths)

    def read(some: list[str], unsplit: bool) -> DataFrame:
        raw = spark.read.schema(spec.raw_struct).options(**CSV_OPTIONS).option("multiLine", str(unsplit).lower()).csv(some)
        return raw.select(
            *spec.column_names,
            F.col("_metadata.file_path").alias("_file"),
            F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias(
                "_ord"
            ),
        )

    parts = [read(some, unsplit) for some, unsplit in ((whole, True), (split, False)) if some]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def load_typed(spark: SparkSession, paths, spec: TableSpec, multi_line: bool | str = True, nulls: str = "null") -> DataFrame:
    """S8 + S10 + S11: typed rows of one table from its files."""
    return sanitize(read_registry_csv(spark, paths, spec, multi_line), spec, nulls)


def to_registry_text(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed rows → the published text form (decimal comma, plain integers)."""
    from ..schema import NUMERIC

    out = []
    for c, k in spec.columns:
        v = F.col(c).cast("string")
        if k == NUMERIC:
            v = F.replace(v, F.lit("."), F.lit(","))
        out.append(v.alias(c))
    return df.select(*out)


def write_registry_csv(df: DataFrame, spec: TableSpec, path: str, files: int | None = None, compression: str = "none") -> None:
    """Write typed rows as registry text files (Latin-1, ``;``, all fields quoted)."""
    text = to_registry_text(df, spec)
    if files:
        text = text.repartition(files)
    (
        text.write.mode("overwrite")
        .option("sep", ";")
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", "true")
        .option("encoding", "ISO-8859-1")
        .option("header", "false")
        .option("compression", compression)
        .csv(path)
    )
