"""Sinks (K1–K8).

Canonical outputs are tables (parquet / JSON lines) written by executors in
parallel.  The reference's single-document shapes (one JSON envelope with all
rows, one Markdown report) are produced as *tables plus a manifest* and as an
ordered table of lines (K7).
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from regcorpus.functions import extract as X
from regcorpus.functions.text import safe_name
from regcorpus.sources.files import in_fewer_tasks, scan_tasks

# --- fixed values: what a task that lists or reads files gives on at once, and
# the files that are worth a task
ENTRIES_PER_BATCH = 10_000
BYTES_PER_BATCH = 8 << 20
FILES_PER_TASK = 32
# ------------------------------------------------------------------------------


def write_envelope(rows: DataFrame, path: str, fetched_at: str, total_name: str) -> int:
    """K1: rows as JSON lines under ``path/rows`` and a one-row manifest
    ``{fetched_at, total_<name>}`` under ``path/manifest``.  The row count is
    observed during the write (``Observation``: one pass over the rows); with
    no rows no manifest is written (the rows folder holds no records).
    Returns the row count."""
    from pyspark.sql import Observation
    obs = Observation()
    rows.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(f"{path}/rows")
    n = int(obs.get["n"])
    if n == 0:
        return 0
    rows.sparkSession.createDataFrame([(fetched_at, n)], f"fetched_at string, {total_name} long") \
        .coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return n


def write_json_document(rows: DataFrame, path: str, order_cols: list, fetched_at: str, total_name: str, rows_name: str = "rows") -> int:
    """K1 as one document: text files whose concatenation in name order is
    ``{"fetched_at": ..., total_name: n, rows_name: [...]}``, one row a line in
    the order of ``order_cols``.  Returns the number of rows.

    The rows are sorted by range and written once with their running numbers;
    the first one's number and their count give the header and the commas, so
    no task holds more than its range.  No rows give an empty list."""
    spark = rows.sparkSession
    own = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"})
    rows.orderBy(*order_cols).select(own.alias("line")).withColumn("no", F.monotonically_increasing_id()).write.parquet(f"{path}/staged")
    staged = spark.read.parquet(f"{path}/staged")
    low, n = staged.agg(F.min("no"), F.count("*")).first()
    head = json.dumps({"fetched_at": fetched_at, total_name: n})[:-1] + f", {json.dumps(rows_name)}: ["
    ends = spark.createDataFrame([(0, 0, head), (2, 0, "]}")], "part int, no long, line string")
    body = staged.select(F.lit(1).alias("part"), "no", F.when(F.col("no") == (low or 0), F.col("line")).otherwise(F.concat(F.lit(","), F.col("line"))).alias("line"))
    ends.unionByName(body).orderBy("part", "no").select("line").write.text(f"{path}/document")
    return n


def read_json_document(spark: SparkSession, path: str, schema, total_name: str) -> DataFrame:
    """The rows of ``write_json_document``, each with the document's total."""
    lines = spark.read.text(f"{path}/document")
    head = lines.filter(F.col("value").startswith('{"fetched_at"')).first()
    total = json.loads(head["value"] + "]}")[total_name]
    rows = lines.filter(F.col("value").rlike(r"^,?\{") & ~F.col("value").startswith('{"fetched_at"'))
    parsed = rows.select(F.from_json(F.regexp_replace("value", "^,", ""), schema).alias("r"))
    return parsed.select("r.*", F.lit(total).cast("long").alias(total_name))


def write_json_records(rows: DataFrame, path: str) -> None:
    """K2: the records as JSON (no envelope)."""
    rows.write.mode("overwrite").json(path)


def write_per_keyword(hits: DataFrame, path: str, keyword_col: str = "keyword") -> DataFrame:
    """K3: one folder per keyword (safe name, X9) plus a summary table;
    the original keyword stays a column because safe names can collide."""
    out = hits.withColumn("keyword_safe", safe_name(F.col(keyword_col)))
    # adaptive execution joins small keywords' tasks and splits a hot keyword by its size
    out.hint("rebalance", "keyword_safe").write.mode("overwrite").partitionBy("keyword_safe").json(f"{path}/by_keyword")
    written = out.sparkSession.read.schema(out.schema).json(f"{path}/by_keyword")
    summary = written.groupBy("keyword_safe", keyword_col).agg(F.count("*").alias("n_results"))
    summary.write.mode("overwrite").json(f"{path}/summary")
    return summary


def judgment_documents(j: DataFrame, language: str = "PL") -> DataFrame:
    """K4: ``(file_name, content)`` = X7 name and X12 front matter + blank
    line + Markdown body."""
    fm = X.judgment_front_matter(F.col("celex"), F.col("title"), F.col("date"), language)
    return j.select(X.judgment_file_name(F.col("celex"), F.col("date")).alias("file_name"),
                    F.concat(fm, F.lit("\n\n"), F.col("markdown")).alias("content"))


def markdown_path(path_col: str = "path"):
    """K5: the input path with its extension replaced by ``.md`` (added where
    there is none)."""
    path = F.col(path_col)
    return F.when(path.rlike(r"[^/]\.[^./]+$"), F.regexp_replace(path, r"\.[^./]+$", ".md")).otherwise(F.concat(path, F.lit(".md")))


def flag_path_collisions(df: DataFrame, path_col: str = "path_md") -> DataFrame:
    """K5: mark outputs whose target path is shared by another input
    (``a.html`` and ``a.xml`` both become ``a.md``); the window is per
    target path, i.e. a handful of rows."""
    from pyspark.sql import Window
    return df.withColumn("path_collision", F.count("*").over(Window.partitionBy(path_col)) > 1)


def mirrored_paths(df: DataFrame, path_col: str = "path", text_col: str = "markdown") -> DataFrame:
    """K5: ``(path, markdown)`` with every input's target path.  Of inputs that
    share one the first by name keeps it, the others keep their extension too
    (``a.xml.md``), and a number where even that is taken."""
    from pyspark.sql import Window
    rows = df.select(F.col(path_col).alias("own"), F.col(text_col).alias("markdown")).withColumn("path", markdown_path("own"))
    same = Window.partitionBy("path").orderBy("own")
    k = F.row_number().over(same)
    again = F.row_number().over(Window.partitionBy("path", "own").orderBy("own"))
    rows = rows.withColumn("k", k).withColumn("again", again)
    number = F.when(F.col("again") > 1, F.concat(F.lit("."), F.col("again").cast("string"))).otherwise("")
    return rows.select(F.when(F.col("k") == 1, F.col("path")).otherwise(F.concat("own", number, F.lit(".md"))).alias("path"), "markdown")


def write_mirrored(files: DataFrame, path: str, named=None) -> None:
    """K5: one file per row at ``path/<path>``, through the data source
    ``mirrored_files``: tasks write under a folder of their own, and when all
    are done a second job moves the files to their places, a task for each
    folder; a failed write leaves none.

    With ``named`` (``mirrored_paths``) the rows' places are not their paths
    but what it makes of them.  It works on paths and names of staged files:
    the texts are written where they are read, without an exchange, and the
    places are known before the first file is moved."""
    spark = files.sparkSession
    spark.dataSource.register(MirroredFiles)
    files.select("path", "markdown").write.format("mirrored_files").mode("append").option("moves", "later").option("names", "later" if named else "now").save(path)
    store, root = _store(path)
    with store.open_input_stream(f"{root}/{COMMITTED}") as written:
        folders = written.read().decode().splitlines()

    def move(folder):
        place, top = _store(path)
        _move_files(place, top, folder)

    if folders and named:
        _move_named(spark.read.schema("path string, markdown string").parquet(*[f"{path}/_staged/{f.rsplit('/', 1)[1]}.parquet" for f in folders]), path, named)
    elif folders:
        spark.sparkContext.parallelize(folders, len(folders)).foreach(move)
    store.delete_dir(f"{root}/_staged")


def _move_named(staged: DataFrame, path: str, named) -> None:
    """The staged files, given as ``(path, markdown: name of the staged file)``,
    to the places that ``named`` makes of their paths.  The places are written
    first: a task that runs again finds the same."""
    try:
        named(staged).write.parquet(f"{path}/_staged/places")
        places = staged.sparkSession.read.schema("path string, markdown string").parquet(f"{path}/_staged/places")
        bad = places.filter(F.col("path").isNull() | F.array_contains(F.split("path", "/"), "..")).first()
        if bad:
            raise ValueError(f"path leaves the folder: {bad.path}")
    except Exception:
        _drop_staged(path)
        raise

    def moved(batches):
        import pyarrow as pa
        from pyarrow import fs
        store, root = _store(path)
        made = set()
        for batch in batches:
            for name, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                source, target = f"{root}/_staged/{own}", f"{root}/{name.strip('/')}"
                parent = target.rsplit("/", 1)[0]
                if parent not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                try:
                    store.move(source, target)
                except FileNotFoundError:
                    if store.get_file_info(target).type == fs.FileType.NotFound:
                        raise
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]}, pa.schema([("n", pa.int64())]))

    places.repartition(_tasks(places)).mapInArrow(moved, "n long").write.format("noop").mode("overwrite").save()


def _tasks(files: DataFrame) -> int:
    """The tasks for a table of small files' names."""
    return max(1, min(scan_tasks(files.sparkSession), -(-files.count() // FILES_PER_TASK)))


def read_mirrored(spark: SparkSession, path: str, suffix: str = ".md") -> DataFrame:
    """``(path, markdown)`` of the files under a folder, paths relative to it
    (like Spark's file scan it passes over files without a byte).  Tasks list
    the folders and read the files: of Spark's scan the driver holds every
    file.  What pyarrow does not see as a folder is left to that scan."""
    root = "/" + path.split(":", 1)[-1].strip("/") + "/"
    uri = _folder_uri(spark, path)
    if uri is None:
        raw = in_fewer_tasks(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(path))
    else:
        raw = _contents(_listed(spark, uri, f"*{suffix}"), uri)
    name = F.try_url_decode(F.regexp_replace(F.regexp_replace("path", "^[a-z0-9]+:/*", "/"), r"\+", "%2B"))
    return raw.select(F.substring_index(name, root, -1).alias("path"), F.decode("content", "UTF-8").alias("markdown"))


def _folder_uri(spark: SparkSession, path: str) -> str | None:
    """A folder's path as Spark spells it; None if pyarrow sees no folder there."""
    from py4j.protocol import Py4JError
    from pyarrow import fs
    try:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        uri = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()
        store, root = _found(uri)
        return uri.rstrip("/") if store.get_file_info(root or "/").type == fs.FileType.Directory else None
    except (Py4JError, OSError, ValueError):
        return None


def _found(uri: str):
    """The file system of a folder as Spark spells it, and the folder in it."""
    from urllib.parse import quote

    from pyarrow import fs
    store, root = fs.FileSystem.from_uri(quote(uri, safe=":/@"))
    return store, root.rstrip("/")


def _entries(store, folder: str):
    """``(name, whether a folder)`` of a folder's entries; those of a local
    folder, which may be very many, as they come."""
    from pyarrow import fs
    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(folder) as entries:
            yield from ((e.name, e.is_dir()) for e in entries if e.is_dir() or e.is_file())
    else:
        yield from ((e.base_name, e.type == fs.FileType.Directory) for e in store.get_file_info(fs.FileSelector(folder)))


def _hidden(name: str, folder: bool) -> bool:
    """What Spark's file scan passes over."""
    return (name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")) \
        and not (folder and name.startswith(("_metadata", "_common_metadata")))


def _listed(spark: SparkSession, uri: str, glob: str) -> DataFrame:
    """``(name)`` of the files at all depths of a folder, relative to it, as a
    table under the shared folder: a level of folders at a time, a folder
    being one task's work; only their number comes to the driver."""
    from regcorpus.session import scratch_path
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    schema = "name string, folder boolean"

    def entries(batches):
        import re

        import pyarrow as pa
        store, root = _found(uri)
        fits, rows = re.compile(pattern, re.S).fullmatch, []

        def batch():
            return pa.RecordBatch.from_pydict({"name": [x for x, _ in rows], "folder": [x for _, x in rows]}, pa.schema([("name", pa.string()), ("folder", pa.bool_())]))

        for folders in batches:
            for above in folders.column("name").to_pylist():
                for name, folder in _entries(store, f"{root}/{above}"):
                    if not _hidden(name, folder) and (folder or fits(name)):
                        rows.append((f"{above}/{name}".lstrip("/"), folder))
                    if len(rows) >= ENTRIES_PER_BATCH:
                        yield batch()
                        rows.clear()
        yield batch()

    path, level, folders, n = scratch_path(spark, f"listing-{uuid.uuid4().hex}"), 0, spark.range(1).select(F.lit("").alias("name")), 1
    while n:
        part = f"{path}/level={level}"
        folders.repartition(min(n, int(spark.conf.get("spark.sql.shuffle.partitions")))).mapInArrow(entries, schema).write.parquet(part)
        folders = spark.read.schema(schema).parquet(part).filter("folder").select("name")
        n, level = folders.count(), level + 1
    return spark.read.schema(schema).parquet(path).filter("NOT folder").select("name")


def _contents(files: DataFrame, uri: str) -> DataFrame:
    """``(path, content)`` of the files below a folder, evenly in as many tasks
    as a scan has; files without a byte are passed over."""
    def contents(batches):
        import pyarrow as pa
        store, root = _found(uri)
        schema = pa.schema([("path", pa.string()), ("content", pa.binary())])
        for names in batches:
            rows, held = ([], []), 0
            for name in names.column("name").to_pylist():
                with store.open_input_stream(f"{root}/{name}", compression=None) as f:
                    content = f.read()
                if content:
                    rows[0].append(f"{uri}/{name}")
                    rows[1].append(content)
                    held += len(content)
                if held >= BYTES_PER_BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(rows, schema, strict=True)], schema=schema)
                    rows, held = ([], []), 0
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(rows, schema, strict=True)], schema=schema)

    return files.repartition(_tasks(files)).mapInArrow(contents, "path string, content binary")


# where a commit names the staged folders of the successful attempts
COMMITTED = "_staged/committed"


def _store(path: str):
    """The file system of a path, and the path in it."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path or ":/" in path else "file://" + os.path.abspath(path))


def _drop_staged(path: str) -> None:
    from pyarrow import fs
    store, root = _store(path)
    if store.get_file_info(f"{root}/_staged").type != fs.FileType.NotFound:
        store.delete_dir(f"{root}/_staged")


def _move_files(store, root: str, folder: str) -> None:
    """The files of a staged folder to their places; run again, those that are left."""
    from pyarrow import fs
    made = set()
    for info in store.get_file_info(fs.FileSelector(folder, recursive=True)):
        if info.is_file:
            target = f"{root}/{info.path.split(folder.strip('/') + '/', 1)[1]}"
            parent = target.rsplit("/", 1)[0]
            if parent not in made:
                store.create_dir(parent, recursive=True)
                made.add(parent)
            store.move(info.path, target)


def _write_file(store, path: str, content) -> None:
    with store.open_output_stream(path) as out:
        out.write(content.encode() if isinstance(content, str) else bytes(content or b""))


class _Written(WriterCommitMessage):
    def __init__(self, folder: str):
        self.folder = folder


class MirroredFiles(DataSource):
    """Write side of ``mirrored_files``: rows ``(path, markdown)`` as files;
    strings in UTF-8, binary content as it is."""

    @classmethod
    def name(cls):
        return "mirrored_files"

    def schema(self):
        return "path string, markdown string"

    def writer(self, schema, overwrite):
        return _MirroredWriter(self.options["path"], self.options.get("moves") == "later", self.options.get("names") == "later")


class _MirroredWriter(DataSourceWriter):
    """Two phases: a task writes its files below ``_staged/<attempt>``, the
    commit moves those of successful attempts (with ``later`` it names them in
    ``COMMITTED``), the abort removes the folder.  With ``numbered`` the files
    are named by numbers, and ``_staged/<attempt>.parquet`` has their paths."""

    def __init__(self, path: str, later: bool = False, numbered: bool = False):
        self.path = path
        self.later = later
        self.numbered = numbered

    def _files(self):
        return _store(self.path)

    def write(self, iterator):
        store, root = self._files()
        folder = f"{root}/_staged/{uuid.uuid4().hex}"
        store.create_dir(folder, recursive=True)
        if self.numbered:
            self._write_numbered(store, folder, iterator)
            return _Written(folder)
        made = {folder}
        for row in iterator:
            name = row[0].strip("/")
            if ".." in name.split("/"):
                raise ValueError(f"path leaves the folder: {name}")
            parent = f"{folder}/{name}".rsplit("/", 1)[0]
            if parent not in made:
                store.create_dir(parent, recursive=True)
                made.add(parent)
            _write_file(store, f"{folder}/{name}", row[1])
        return _Written(folder)

    def _write_numbered(self, store, folder, iterator):
        import pyarrow as pa
        from pyarrow import parquet
        schema, attempt, names = pa.schema([("path", pa.string()), ("markdown", pa.string())]), folder.rsplit("/", 1)[1], []
        with store.open_output_stream(f"{folder}.parquet") as named, parquet.ParquetWriter(named, schema) as paths:
            for i, row in enumerate(iterator):
                names.append({"path": row[0], "markdown": f"{attempt}/{i}"})
                _write_file(store, f"{folder}/{i}", row[1])
                if len(names) >= ENTRIES_PER_BATCH:
                    paths.write_batch(pa.RecordBatch.from_pylist(names, schema))
                    names.clear()
            paths.write_batch(pa.RecordBatch.from_pylist(names, schema))

    def commit(self, messages):
        store, root = self._files()
        folders = [m.folder for m in messages if m is not None]
        store.create_dir(f"{root}/_staged", recursive=True)
        if self.later:
            with store.open_output_stream(f"{root}/{COMMITTED}") as out:
                out.write("\n".join(folders).encode())
            return
        for folder in folders:
            _move_files(store, root, folder)
        store.delete_dir(f"{root}/_staged")

    def abort(self, messages):
        _drop_staged(self.path)


def write_bronze(df: DataFrame, path: str, partition_cols=()) -> None:
    """K6/K8: append raw content with its metadata columns (raw always kept)."""
    w = df.write.mode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def alert_report(alerts: DataFrame, order_cols: tuple, generated: str) -> DataFrame:
    """K7: every line of the Markdown summary as a table ``(part, *order_cols,
    line_no, line)``: part 0 is the header with the total, part 1 the six
    lines of each alert.  ``""`` stays ``""``; an absent field prints ``N/A``;
    an explicit null prints ``None``.  Sorted by its columns up to ``line_no``
    the lines are the report."""
    def v(c):
        return F.coalesce(F.col(c), F.lit("None")) if c in alerts.columns else F.lit("N/A")
    lines = F.array(
        F.concat(F.lit("### "), v("reference"), F.lit(" ("), v("date"), F.lit(")")),
        F.concat(F.lit("- **Type:** "), v("notification_type")),
        F.concat(F.lit("- **Subject:** "), v("subject")),
        F.concat(F.lit("- **Hazard:** "), v("hazard")),
        F.concat(F.lit("- **Origin:** "), v("origin_country")),
        F.lit(""))
    head = F.array(F.lit("# RASFF Notifications Summary"), F.lit(""), F.concat(F.lit("Generated: "), F.lit(generated)),
                   F.concat(F.lit("Total notifications: "), F.col("n").cast("string")), F.lit(""),
                   F.lit("## Notifications"), F.lit(""))
    header = alerts.agg(F.count("*").alias("n")).select(F.lit(0).alias("part"), *[
        F.lit(None).cast(alerts.schema[c].dataType).alias(c) for c in order_cols], F.posexplode(head).alias("line_no", "line"))
    body = alerts.select(F.lit(1).alias("part"), *order_cols, F.posexplode(lines).alias("line_no", "line"))
    return header.unionByName(body)


def write_alert_report(lines: DataFrame, order_cols: tuple, path: str) -> None:
    """K7: the report as text files whose names sort in report order (a range
    sort; no task holds more than its range)."""
    lines.orderBy("part", *order_cols, "line_no").select("line").write.mode("overwrite").text(path)
