"""Links of Markdown files, their targets, and the graph between files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regcorpus.operators.corpus import link_graph

CODE = r"(?ms)^(```|~~~).*?^\1|`[^`\n]*`"
LINK = r'(?<!!)\[((?:[^\[\]]|\[[^\[\]]*\])*)\]\(\s*(?:<([^<>\n]*)>|((?:[^()\s]|\([^()\s]*\))*))(?:\s+(?:"[^"]*"|\'[^\']*\'))?\s*\)'


def markdown_links(files: DataFrame, path_col: str, text_col: str) -> DataFrame:
    """``(path, link_no, label, target)`` of every inline link, in order; images
    and code are not links.  A file without text has none."""
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), CODE, "")
    rows = files.select(F.col(path_col).alias("path"), F.posexplode(F.regexp_extract_all(text, F.lit(LINK), F.lit(0))).alias("link_no", "link"))
    target = F.concat(F.regexp_extract("link", LINK, 2), F.regexp_extract("link", LINK, 3))
    return rows.select("path", "link_no", F.regexp_extract("link", LINK, 1).alias("label"), target.alias("target"))


def normal_path(path: Column) -> Column:
    """A path without ``.``, ``..`` and empty parts, by one fold over its parts;
    ``..`` beyond the root stays."""
    none = F.array().cast("array<string>")

    def step(done: Column, part: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        up = F.when((F.size(done) > 0) & (last != ".."), F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(F.concat(done, F.array(part)))
        return F.when(part.isin("", "."), done).when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    return F.array_join(F.reduce(F.split(path, "/"), none, step), "/")


def link_kind(target: Column) -> Column:
    """``external`` (a scheme or host), ``anchor`` (a place in the same file) or
    ``file``."""
    return F.when(target.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:|//)"), "external") \
        .when((target == "") | target.startswith("#"), "anchor").otherwise("file")


def resolved_target(path: Column, target: Column) -> Column:
    """The file that a link leads to: relative to the folder of ``path``, or to
    the root with a leading slash; query and fragment removed."""
    name = F.try_url_decode(F.regexp_replace(F.regexp_replace(target, r"[?#].*$", ""), r"\+", "%2B"))
    folder = F.regexp_replace(path, r"[^/]*$", "")
    return normal_path(F.when(target.startswith("/"), F.coalesce(name, target)).otherwise(F.concat(folder, F.coalesce(name, target))))


def link_targets(files: DataFrame, path_col: str, text_col: str) -> DataFrame:
    """Every link with ``kind``, the ``file`` it leads to and ``status``: ok,
    dangling (no such file), anchor or external.  Only file names are joined."""
    links = markdown_links(files, path_col, text_col).withColumn("kind", link_kind(F.col("target"))) \
        .withColumn("file", F.when(F.col("kind") == "file", resolved_target(F.col("path"), F.col("target")))
                    .when(F.col("kind") == "anchor", normal_path(F.col("path"))))
    held = files.select(normal_path(F.col(path_col)).alias("file")).distinct().withColumn("held", F.lit(True))
    status = F.when(F.col("kind") == "file", F.when(F.col("held"), "ok").otherwise("dangling")).otherwise(F.col("kind"))
    return links.join(held, "file", "left").select("path", "link_no", "label", "target", "kind", "file", status.alias("status"))


def file_graph(targets: DataFrame) -> DataFrame:
    """In- and out-degree of files over their resolved links (distinct, none to
    the file itself), and links that are not returned."""
    edges = targets.filter("status = 'ok'").select(normal_path(F.col("path")).alias("src"), F.col("file").alias("dst")).filter("src <> dst")
    return link_graph(edges)
