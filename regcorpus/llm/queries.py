"""Registered queries of the operators in this subpackage and their SQL.

``opN_<name>`` applies operator N to its whole table with production
parameters; the digest columns of the contracts are derived here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regcorpus.llm import (
    bpe,
    exact_dedup,
    html_extract,
    merkle,
    mixing,
    ngram_join,
    periodic,
    secret_scan,
    spot_sigs,
    substring_dedup,
    token_counts,
    toxicity,
    vector_dedup,
)
from regcorpus.llm.rows import KEY
from regcorpus.llm.store import written

QUERIES = {}
ORACLES = {}


def _register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _tokenizer() -> tuple[dict, str]:
    """Ranks and pattern of the public byte-level vocabulary."""
    import public_tokenizers
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_register
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of ``documents`` by block naming."""
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents")).drop(*KEY)


ORACLES["op1_exact_dedup"] = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                  regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256, n_chars
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n_chars DESC, doc_id)
"""


@_register
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` linked at 4-word Jaccard 0.85 or more."""
    return ngram_join.ngram_components(_table(spark, sf_dir, "documents")).drop("class_id", "group_id", *KEY)


ORACLES["op2_ngram_jaccard_join"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_distinct(list_transform(
    range(1, greatest(2, len(ws) - 2)), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS g FROM w),
p AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM p a JOIN p b ON a.g = b.g AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM documents
          UNION SELECT r.node, l.y FROM reach r JOIN links l ON r.seen = l.x)
SELECT s.doc_id, len(g) AS n_shingles, c.component_id
FROM s JOIN (SELECT node, min(seen) AS component_id FROM reach GROUP BY node) c ON c.node = s.doc_id
"""


@_register
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` outside 35-word windows that occur elsewhere."""
    return substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"))


ORACLES["op10_substring_dedup"] = """
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
           FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS i, ws FROM w WHERE len(ws) >= 35),
often AS (SELECT doc_id, i, count(*) OVER (PARTITION BY array_to_string(ws[i:i + 34], ' ')) AS c FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM often WHERE c > 1),
cut AS (SELECT doc_id, count(*) AS n_removed, list(i) AS drop_at FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(CASE WHEN drop_at IS NULL THEN array_to_string(ws, ' ') ELSE array_to_string(list_transform(
         list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(drop_at, i)), lambda i: ws[i]), ' ') END) AS kept_sha256
FROM w LEFT JOIN cut ON cut.doc_id = w.doc_id
"""


@_register
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of ``documents``, encoded and decoded again."""
    return bpe.round_trip(_table(spark, sf_dir, "documents"), *_tokenizer())


@_register
def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` mixed to the sources' target weights."""
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("copies", *KEY)


@_register
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all ``embeddings`` of one label, cosine 0.98 or more."""
    return vector_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


ORACLES["op7_embedding_near_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
       AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
          AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS node, vec_id AS seen FROM v UNION SELECT r.node, l.y FROM reach r JOIN links l ON r.seen = l.x),
c AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
n AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON c.node = v.vec_id LEFT JOIN n ON n.x = v.vec_id
"""


@_register
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all ``documents``, learned from ``labels``."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


@_register
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all ``documents``: base patterns and Markov spans."""
    found = secret_scan.secret_spans(_table(spark, sf_dir, "documents"))
    count = [secret_scan.number_of(F.col("base"), k).alias(f"n_{name}")
             for k, name in enumerate(secret_scan.KINDS[:3])]
    return found.select("doc_id", *count, F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.listed(F.col("spans")).alias("spans"))


@_register
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` written as flat token files, and the tokens of every
    document counted from the files alone."""
    files = written(token_counts.token_files(_table(spark, sf_dir, "documents"), *_tokenizer()), "tokens")
    scanned = written(token_counts.separators(files), "separators")
    return token_counts.token_counts(files, scanned).select("doc_id", "n_tokens")


@_register
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all ``pages``."""
    pages = _table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


@_register
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all ``documents``; every fifth one (by checksum) comes back
    with a text in lower case."""
    docs = _table(spark, sf_dir, "documents")
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.leaf([*values, lower]))
    leaves = docs.select(F.col("source").cast("string").alias("tree"), F.col("doc_id").cast("bigint").alias("id"),
                         merkle.leaf([*values, F.col("text")]).alias("leaf"), tampered.alias("claimed"))
    return merkle.manifest(leaves).select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _looped(docs: DataFrame) -> DataFrame:
    """Documents; where the id's checksum says so, the words from some word on
    repeat a stretch of the text (null ids have no checksum and stay)."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", h.alias("h"), F.floor(h / 10).cast("bigint").alias("g"),
                         F.when(h % 10 == 0, words).alias("words"))
    n, a, p = F.size("words"), F.col("a"), F.col("p")
    sized = chosen.withColumn("n", F.when(n > 0, n)).withColumn("a", (F.col("g") % F.col("n")).cast("int")) \
        .withColumn("p", (1 + F.floor((F.col("n") - a) / (3 + F.col("g") % 8))).cast("int"))
    left = F.col("n") - a
    loop = F.slice(F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil(left / p).cast("int"))), F.lit(1), left)
    return sized.select("doc_id", F.when(F.col("n").isNotNull(), F.array_join(F.concat(F.slice("words", F.lit(1), a), loop), " "))
                        .otherwise(F.col("text")).alias("text"))


@_register
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all ``documents``, some with looped words, and the
    texts without what the runs repeat."""
    found = periodic.periodic_runs(_looped(_table(spark, sf_dir, "documents")))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.reduce("runs", none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@_register
def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and of the same texts with their last
    half from the next document."""
    beside = spot_sigs.with_next(_table(spark, sf_dir, "documents"), "doc_id", "text").withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substr("next_text", F.lit(1), half))
    both = spot_sigs.with_signatures(beside.withColumn("edited", edited), "edited", "edited_signatures")
    return both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       spot_sigs.printed(F.col("signatures")).alias("fingerprint"),
                       spot_sigs.printed(F.col("edited_signatures")).alias("edited_fingerprint"),
                       spot_sigs.likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
                       spot_sigs.likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"))


def _merkle_sql() -> str:
    """Levels, proofs and folds by recursive queries over row numbers."""
    def values(text):
        parts = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(f"coalesce(CAST(strlen({p}) AS VARCHAR) || ':' || {p}, '-')" for p in parts) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bit = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    byte_list = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    crc = f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {byte_list}), lambda c, b: {bit}), 4294967295)"

    def climb(name, base, key):
        return (f"{name} AS ({base} UNION ALL SELECT lvl + 1, {key}, place // 16, sha256(string_agg(h, '' ORDER BY place)), (n + 15) // 16 "
                f"FROM {name} WHERE n > 1 GROUP BY lvl, {key}, place // 16, n)")

    def runs(name, key):
        return f"SELECT lvl, {key}, place // 16 AS run, list(h ORDER BY place) AS hs FROM {name} WHERE n > 1 GROUP BY lvl, {key}, place // 16"

    def slot(place, lvl):
        return f"CAST(({place} // CAST(power(16, {lvl}) AS BIGINT)) % 16 AS BIGINT)"

    def sides(place, lvl):
        at = slot(place, lvl)
        return f"array_to_string(hs[1:{at}], '') AS l, array_to_string(hs[{at} + 2:], '') AS r"

    def run_of(place, lvl):
        return f"{place} // CAST(power(16, {lvl} + 1) AS BIGINT)"

    return f"""
WITH RECURSIVE d AS (SELECT doc_id, source, {values("text")} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {values(lower)} END AS claimed FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n,
                  row_number() OVER () AS rid FROM d),
{climb("lv", "SELECT 0 AS lvl, source, place, leaf AS h, n FROM leaves", "source")},
trees AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM lv WHERE n = 1),
{climb("tv", "SELECT 0 AS lvl, 0 AS one, place, subroot AS h, n FROM trees", "one")},
lr AS ({runs("lv", "source")}), tr AS ({runs("tv", "one")}),
steps AS (
  SELECT rid, lr.lvl, {sides("place", "lr.lvl")} FROM leaves JOIN lr ON lr.source IS NOT DISTINCT FROM leaves.source AND lr.run = {run_of("place", "lr.lvl")}
  UNION ALL
  SELECT rid, 100 + tr.lvl, {sides("t.place", "tr.lvl")} FROM leaves JOIN trees t ON t.source IS NOT DISTINCT FROM leaves.source
  JOIN tr ON tr.run = {run_of("t.place", "tr.lvl")}),
ordered AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY lvl) AS k FROM steps),
fold AS (SELECT rid, CAST(0 AS BIGINT) AS k, coalesce(claimed, leaf) AS x FROM leaves
         UNION ALL SELECT f.rid, o.k, sha256(o.l || f.x || o.r) FROM fold f JOIN ordered o ON o.rid = f.rid AND o.k = f.k + 1),
proofs AS (SELECT rid, sha256(string_agg(l || r, '' ORDER BY lvl)) AS proof_sha256 FROM steps GROUP BY rid)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN trees ON trees.source IS NOT DISTINCT FROM leaves.source CROSS JOIN (SELECT h AS root FROM tv WHERE n = 1) x
LEFT JOIN proofs ON proofs.rid = leaves.rid JOIN (SELECT rid, arg_max(x, k) AS folded_root FROM fold GROUP BY rid) f ON f.rid = leaves.rid
"""


ORACLES["op13_merkle_manifest"] = _merkle_sql()
