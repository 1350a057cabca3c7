"""S4-S12 corpus scans over files (any Hadoop filesystem)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T

ARTICLE_SCHEMA = "title string, text string"


def scan_order() -> Column:
    """Sortable place of a row in its files: path, block start, row within the split.

    Splits are packed by size, so a bare row counter does not follow the file
    names; within one block the counter does follow the file."""
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.concat_ws("\u0001", F.col("_metadata.file_path"), F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0"),
                       F.lpad(inside.cast("string"), 12, "0"))


def read_wiki_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines articles; malformed lines dropped, missing/null -> ''.

    ``file``/``ord`` give the reference's walk order (sorted files, line
    order within a file as read)."""
    df = (spark.read.schema(ARTICLE_SCHEMA).option("mode", "DROPMALFORMED").json(path)
               .select(F.coalesce("title", F.lit("")).alias("title"),
                       F.coalesce("text", F.lit("")).alias("text"),
                       F.col("_metadata.file_path").alias("file"), scan_order().alias("ord")))
    return df


def read_wiki_xml(spark: SparkSession, path: str) -> DataFrame:
    """MediaWiki XML dump (``.bz2`` decompressed by extension), one row per page."""
    df = spark.read.format("xml").option("rowTag", "page").load(path)
    rev_text = df.schema["revision"].dataType["text"].dataType if "revision" in df.columns else None
    if rev_text is not None and hasattr(rev_text, "fieldNames") and "_VALUE" in rev_text.fieldNames():
        text = F.col("revision.text._VALUE")
    else:
        text = F.col("revision.text")
    return df.select(F.coalesce(F.col("title").cast("string"), F.lit("")).alias("title"),
                     F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _file_names(spark: SparkSession, path: str) -> list[str]:
    """Files of a path in scan order; names only, no content is read."""
    files = spark.read.format("binaryFile").load(path).select("path")
    return [r["path"] for r in files.orderBy("path").collect()]


def read_news(spark: SparkSession, path: str, limit: int | None = None, fmt: str = "json") -> DataFrame:
    """documents' ``text`` with their scan order; with ``limit`` the first so many (O2 cap).

    A cap reads files in scan order, one, then two, four, eight more, until
    they hold enough rows; files after that are not opened.
    """
    from quarry.operators.sampling import first_n

    def load(where):
        return spark.read.schema("text string").format(fmt).load(where).select("text", scan_order().alias("ord"))

    if limit is None:
        return load(path)
    names, taken, found = _file_names(spark, path), 0, 0
    while taken < len(names) and found < limit:
        more = names[taken:taken + max(1, taken)]
        found += load(more).count()
        taken += len(more)
    return first_n(load(names[:taken]), "ord", limit) if taken else load(path).limit(0)


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file; ``doc_id`` is the file's ordinal in sorted path order.

    Files of no bytes give no row (Spark's scans pass them over) and take no ordinal.
    Names alone are ranked (one row per file); the texts stay where they are read."""
    from quarry.operators.sampling import global_rank
    df = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"),
                                                      F.col("value").alias("text"))
    ranks = global_rank(df.select("path"), "path").select("path", F.col("_rank").alias("doc_id"))
    return df.join(ranks, "path").select("path", "text", "doc_id")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, line) with universal newlines, from whole files so
    line order is exact."""
    files = read_whole_files(spark, path)
    return files.select("path", "doc_id", F.posexplode(T.file_lines("text")).alias("line_no", "line"))


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """Gzip text of URLs; trimmed; F9 predicate applied."""
    u = spark.read.text(path).select(T.py_strip("value").alias("url"))
    return u.filter(T.valid_url("url"))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


# Where a split's file may lie below the base folder, in the order they are tried.
DIALOG_LAYOUTS = ("{split}/dialogues.txt", "{split}/dialogues_{split}.txt", "dialogues_{split}.txt")


def read_dialog_splits(spark: SparkSession, candidates: list[str], splits=("train", "validation", "test"),
                       layouts=DIALOG_LAYOUTS) -> DataFrame:
    """First existing base folder wins, then each split's first existing layout; a missing split yields no rows.

    Output (split, line); format with ``dialog_from_line`` (P18)."""
    base = next((c for c in candidates if _exists(spark, c)), None)
    out = spark.createDataFrame([], "split string, line string")
    for s in splits if base is not None else ():
        places = [f"{base.rstrip('/')}/{layout.format(split=s)}" for layout in layouts]
        found = next((p for p in places if _exists(spark, p)), None)
        if found:
            out = out.unionByName(spark.read.text(found).select(F.lit(s).alias("split"), F.col("value").alias("line")))
    return out


def read_tokens(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Token tables (doc_id, ids); comma-separated or list of paths."""
    if isinstance(paths, str):
        paths = [p for p in paths.split(",") if p]
    return spark.read.parquet(*paths)
