"""Landed files and corpus layouts.

File listing and reading are Spark data sources (``binaryFile``, ``text``,
``json``, ``csv``); parsing is column expressions on the read text.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regcorpus.operators.quality import decode_text

log = logging.getLogger(__name__)

# --- fixed values -------------------------------------------------------------
CONVERT_EXTENSIONS = ("html", "htm", "xml", "xhtml")
VALIDATE_EXTENSIONS = ("md", "html", "json")
SIDECAR_SUFFIX = ".meta.txt"
# tasks of a scan for every core, at most (or the shuffle partitions, if more)
SCAN_TASKS = 16
# The food-law acts fetched by default
SEED_ACTS = ("32002R0178", "32011R1169", "32006R1924", "32006R1925", "32015R2283", "32004R0852", "32004R0853", "32023R0915", "32013R0609",
             "32005R0396", "32016R0127", "32016R0128", "32017R1798", "32008R1333", "32008R1334", "32008R1332", "32011R0010", "32004R1935",
             "32003R2065", "32009R1107", "32006R1881")
# ------------------------------------------------------------------------------


def seed_acts(spark: SparkSession, numbers: tuple = SEED_ACTS) -> DataFrame:
    """The acts to fetch as a table ``(celex)``."""
    return spark.createDataFrame([(n,) for n in numbers], "celex string")


def scan_landed(spark: SparkSession, path: str, extensions=CONVERT_EXTENSIONS, recursive: bool = True,
                exclude_suffix: str = SIDECAR_SUFFIX) -> DataFrame:
    """S1 + U3: landed files by extension (brace glob), optionally recursive,
    sidecars excluded.  ``(path, length, content, modificationTime)``."""
    glob = "*.{" + ",".join(extensions) + "}" if len(extensions) > 1 else f"*.{extensions[0]}"
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", str(recursive).lower()).load(path))
    return in_fewer_tasks(df).filter(~F.col("path").endswith(exclude_suffix))


def in_fewer_tasks(df: DataFrame) -> DataFrame:
    """A scan of many small files in tasks of more files: Spark packs some
    thirty into a task, and a task of a conversion costs more than they do."""
    return df.coalesce(scan_tasks(df.sparkSession))


def scan_tasks(spark: SparkSession) -> int:
    """The tasks of a scan of many small files."""
    return max(SCAN_TASKS * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def scan_directories(spark: SparkSession, dirs: list, extensions=VALIDATE_EXTENSIONS) -> DataFrame:
    """S11 + U2: several directories, missing ones skipped with a warning;
    overlapping directories keep duplicates (UNION ALL)."""
    out = None
    for d in dirs:
        if not _exists(spark, d):
            log.warning("directory missing or not a directory: %s", d)
            continue
        df = scan_landed(spark, d, extensions, True, exclude_suffix="\0").withColumn("input_dir", F.lit(d))
        out = df if out is None else out.unionByName(df)
    if out is None:
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long, "
                                         "content binary, input_dir string")
    return out


def decoded(df: DataFrame, content_col: str = "content") -> DataFrame:
    """Add ``text`` (UTF-8, else Latin-1) and drop blank documents."""
    t = decode_text(F.col(content_col))
    return df.withColumn("text", t).withColumn(
        "status", F.when(F.regexp_replace("text", r"(?U)\s+", "") == "", "failed: blank document").otherwise("ok"))


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """``key: value`` lines -> (file, key, value); split on the first
    ``": "`` only."""
    df = spark.read.text(path).withColumn("file", F.col("_metadata.file_path"))
    kv = r"^([^:]+): (.*)$"
    return df.filter(F.col("value").rlike(kv)).select(
        "file", F.regexp_extract("value", kv, 1).alias("key"), F.regexp_extract("value", kv, 2).alias("value"))


def read_act_metadata(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Act metadata JSON documents (one pretty-printed object per file, or
    JSON lines); the open nested ``api_details`` is kept as VARIANT."""
    raw = spark.read.text(path, wholetext=one_per_file)
    v = F.try_parse_json("value")
    return raw.select(
        F.variant_get(v, "$.id", "string").alias("id"), F.variant_get(v, "$.name", "string").alias("name"),
        F.variant_get(v, "$.title", "string").alias("title"),
        F.variant_get(v, "$.dziennik", "string").alias("dziennik"),
        F.variant_get(v, "$.api_details", "variant").alias("api_details"))


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """Landed triples as TSV ``subject<TAB>predicate<TAB>object``."""
    return spark.read.csv(path, sep="\t", schema="subject string, predicate string, object string")


TERM = r"<([^<>\"{}|^`\x00-\x20]*)>"
BLANK = r"(_:[^\s<>\"]+)"
NTRIPLE = (rf"^\s*(?:{TERM}|{BLANK})\s*{TERM}\s*(?:{TERM}|{BLANK}|" + r'"((?:[^"\\\n\r]|\\.)*+)"(?:@([A-Za-z]+(?:-[A-Za-z0-9]+)*)|\^\^' + TERM + r")?)\s*\.\s*(?:#.*)?$")
# fixed values: letters after a backslash
ESCAPES = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}


def unescaped(text):
    """Backslash escapes of N-Triples resolved."""
    names = F.create_map(*[F.lit(x) for kv in ESCAPES.items() for x in kv])

    def value(p):
        code = F.lpad(F.substring(p, 3, 8), 8, "0")
        return F.when(~p.startswith("\\"), p).when(p.rlike(r"^\\[uU]"), F.decode(F.unhex(code), "UTF-32")) \
            .otherwise(F.coalesce(F.try_element_at(names, F.substring(p, 2, 1)), p))
    parts = F.regexp_extract_all(text, F.lit(r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\.|[^\\]++"), F.lit(0))
    return F.when(text.contains("\\"), F.array_join(F.transform(parts, value), "")).otherwise(text)


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    """Landed N-Triples: ``(subject, predicate, object, kind, language,
    datatype)``; ``kind`` is iri, blank or literal.  Comments and blank lines
    are left out; a line that is no triple gives NULLs and ``kind`` bad."""
    lines = spark.read.text(path).filter(~F.col("value").rlike(r"^\s*(?:#.*)?$"))
    g = [F.regexp_extract("value", NTRIPLE, i) for i in range(1, 9)]
    ok = F.col("value").rlike(NTRIPLE)
    quoted = F.col("value").rlike(rf"^\s*(?:{TERM}|{BLANK})\s*{TERM}\s*\"")
    iri = lambda a, b: unescaped(F.when(a != "", a).otherwise(b))
    return lines.select(F.when(ok, iri(g[0], g[1])).alias("subject"), F.when(ok, unescaped(g[2])).alias("predicate"),
                        F.when(ok, F.when(quoted, unescaped(g[5])).otherwise(iri(g[3], g[4]))).alias("object"),
                        F.when(~ok, "bad").when(quoted, "literal").when(g[4] != "", "blank").otherwise("iri").alias("kind"),
                        F.nullif(g[6], F.lit("")).alias("language"), F.nullif(unescaped(g[7]), F.lit("")).alias("datatype"))


# --- S7 front matter -------------------------------------------------------------
FRONT_MATTER = r"(?s)^---\n(.*?)\n---\n?(.*)$"


def split_front_matter(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``front_matter`` (between the first two ``---`` fences) and ``body``."""
    has = F.col(text_col).rlike(FRONT_MATTER)
    return (df.withColumn("front_matter", F.when(has, F.regexp_extract(text_col, FRONT_MATTER, 1)))
            .withColumn("body", F.when(has, F.regexp_extract(text_col, FRONT_MATTER, 2)).otherwise(F.col(text_col))))


def fm_scalar(key: str, fm_col: str = "front_matter"):
    """A flat ``key: value`` of the front matter, quotes removed; NULL if absent."""
    raw = F.regexp_extract(F.col(fm_col), rf"(?m)^{key}:[ \t]*(.*?)[ \t]*$", 1)
    present = F.col(fm_col).rlike(rf"(?m)^{key}:")
    val = F.regexp_replace(raw, r'^"(.*)"$|^\'(.*)\'$', "$1$2")
    return F.when(present, val)


def fm_list(key: str, fm_col: str = "front_matter"):
    """A list value: ``key: [a, b]`` inline or ``key:`` followed by ``- a`` lines."""
    inline = F.regexp_extract(F.col(fm_col), rf"(?m)^{key}:[ \t]*\[(.*)\][ \t]*$", 1)
    block = F.regexp_extract(F.col(fm_col), rf"(?m)^{key}:[ \t]*\n((?:[ \t]*- .*(?:\n|$))+)", 1)
    items_inline = F.transform(F.split(inline, ","), lambda x: F.regexp_replace(F.trim(x), r'^"|"$', ""))
    items_block = F.transform(F.filter(F.split(block, "\n"), lambda x: F.trim(x) != ""),
                              lambda x: F.regexp_replace(F.regexp_replace(x, r"^[ \t]*- ", ""), r'^"|"$|[ \t]+$', ""))
    return (F.when(inline != "", items_inline).when(block != "", items_block))


# --- S8 Markdown tables, S9 Q&A -----------------------------------------------------
def markdown_table_rows(df: DataFrame, text_col: str, keep=()) -> DataFrame:
    """Rows of every ``| a | b |`` table (header and ``---`` separator
    rows excluded): ``(table_no, row_no, line_no, cells ARRAY<STRING>)``.  The
    window is per document, bounded by one document's lines."""
    from pyspark.sql import Window
    lines = df.select(*keep, F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    t = lines.filter(F.col("line").rlike(r"^\s*\|")).withColumn("is_sep", F.col("line").rlike(r"^\s*\|[\s:|-]+\|\s*$"))
    doc = Window.partitionBy(*keep).orderBy("line_no")
    starts = F.coalesce(F.lag("line_no").over(doc) != F.col("line_no") - 1, F.lit(True))
    heads = F.coalesce(F.lead("is_sep").over(doc) & (F.lead("line_no").over(doc) == F.col("line_no") + 1), F.lit(False))
    t = t.withColumn("_start", starts.cast("int")).withColumn("_head", heads).withColumn("table_no", F.sum("_start").over(doc) - 1)
    cells = F.transform(F.split(F.regexp_replace(F.trim("line"), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    return t.filter(~F.col("is_sep") & ~F.col("_head")).select(
        *keep, "table_no", (F.row_number().over(Window.partitionBy(*keep, "table_no").orderBy("line_no")) - 1).alias("row_no"),
        "line_no", cells.alias("cells"))


QUESTION = r"^##\s+P(\d+):\s*(.*)$"
ANSWER = r"^\*\*O\*\*:\s*(.*)$"


def qa_pairs(df: DataFrame, text_col: str, keep=()) -> DataFrame:
    """``## P<n>: question`` followed by ``**O**: answer`` ->
    ``(q_no, question, answer)``.  The first answer after the question counts,
    with all its lines up to the next heading or answer mark, outer blank lines
    removed (per document windows, bounded by one document)."""
    from pyspark.sql import Window
    lines = df.select(*keep, F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    is_q, is_a = F.col("line").rlike(QUESTION), F.col("line").rlike(ANSWER)
    w = Window.partitionBy(*keep).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    tagged = (lines.withColumn("mark", F.when(is_q, "q").when(is_a, "a").when(F.col("line").rlike(r"^#{1,6}\s"), "h"))
              .withColumn("state", F.last("mark", ignorenulls=True).over(w))
              .withColumn("q_line", F.last(F.when(is_q, F.col("line_no")), ignorenulls=True).over(w))
              .withColumn("a_line", F.last(F.when(is_a, F.col("line_no")), ignorenulls=True).over(w)))
    text = F.when(is_a, F.regexp_extract("line", ANSWER, 1)).otherwise(F.col("line"))
    answers = tagged.filter((F.col("state") == "a") & (F.col("a_line") > F.col("q_line"))).groupBy(*keep, "q_line", "a_line").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", text.alias("t")))), lambda x: x["t"]), "\n").alias("answer"))
    first = answers.groupBy(*keep, "q_line").agg(F.min_by(F.regexp_replace("answer", r"^\s+|\s+$", ""), "a_line").alias("answer"))
    asked = lines.filter(is_q).select(*keep, F.col("line_no").alias("q_line"), F.regexp_extract("line", QUESTION, 1).try_cast("int").alias("q_no"),
                                      F.regexp_extract("line", QUESTION, 2).alias("question"))
    return asked.join(first, [*keep, "q_line"]).select(*keep, "q_no", "question", "answer")
