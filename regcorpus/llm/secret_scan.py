"""Operator 6, secret scans with character Markov models (native).

Base kinds are found by pattern.  Further spans come from two first-order
Markov models over characters, one of random strings and one of ordinary
identifiers: a token is reported where the mean log-likelihood ratio of its
transitions speaks for the random model.  Both models are trained from labelled
samples: values the base patterns mark as keys (random) and the other words,
numbers and identifiers of the corpus (ordinary); their transition counts are one
aggregation each over the whole input.

Only DataFrame functions run: matches and their places come from
``regexp_extract_all`` and ``split`` by the same pattern, and transitions of
candidate tokens are summed by a join with the model, a table of at most
``ALPHABET`` squared rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regcorpus.llm.store import written

# Fixed patterns of the base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
ORDINARY = r"[A-Za-z0-9]{8,}(?:[_-][A-Za-z0-9]+)*"
ALPHABET = 66
KINDS = ("assign", "access", "hex", "markov")
SPAN = "struct<start:int,end:int,kind:int,token:string>"


def _places(text: Column, pattern: str, kind: int, least_group: int = 0, least: int = 0) -> Column:
    """Spans of all matches of ``pattern``; with ``least_group`` only those
    whose group has ``least`` characters or more.  Texts without a match pay
    for one search."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    token = F.regexp_extract_all(text, F.lit(pattern), F.lit(least_group)) if least_group else whole
    between = F.split(text, pattern, -1)
    parts = F.zip_with(F.zip_with(F.slice(between, F.lit(1), F.size(whole)), whole, lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("n"))),
                       token, lambda p, t: F.struct(p["gap"].alias("gap"), p["n"].alias("n"), t.alias("token")))
    # running end of the previous match
    spans = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")),
                        lambda acc, p: F.struct(
                            (acc["at"] + p["gap"] + p["n"]).alias("at"),
                            F.concat(acc["out"], F.array(F.struct((acc["at"] + p["gap"]).alias("start"), (acc["at"] + p["gap"] + p["n"]).alias("end"),
                                                                  F.lit(kind).alias("kind"), p["token"].alias("token")))).alias("out")),
                        lambda acc: acc["out"])
    found = F.filter(spans, lambda s: F.length(s["token"]) >= least) if least else spans
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def _transitions(tokens: DataFrame) -> DataFrame:
    """``token id columns + a, b``: every pair of neighbouring characters,
    ``^`` before the first."""
    chars = F.concat(F.array(F.lit("^")), F.split("token", ""))
    return tokens.withColumn("c", chars).withColumn("p", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("c") - 1), lambda i: F.struct(F.get("c", i - 1).alias("a"), F.get("c", i).alias("b"))))) \
        .withColumn("a", F.col("p.a")).withColumn("b", F.col("p.b")).drop("c", "p", "token")


def markov(samples: DataFrame) -> DataFrame:
    """``a, b, llr`` from labelled tokens ``(token, random, n)``: log of the
    ratio of both models' transition probabilities, add-one smoothed.  One row
    per possible pair, so unseen transitions are scored too."""
    counts = _transitions(samples.filter("token <> ''")).groupBy("a", "b").agg(
        F.sum(F.when(F.col("random"), F.col("n")).otherwise(0)).alias("r"), F.sum(F.when(F.col("random"), 0).otherwise(F.col("n"))).alias("o"))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
    every = samples.sparkSession.range(1).select(F.explode(F.split(F.lit("^" + letters), "")).alias("a")) \
        .withColumn("b", F.explode(F.split(F.lit(letters), "")))
    full = every.join(counts, ["a", "b"], "left").fillna(0, ["r", "o"])
    total = full.groupBy("a").agg(F.sum("r").alias("ra"), F.sum("o").alias("oa"))
    size = float(len(letters))
    return full.join(total, "a").select("a", "b", (
        F.log((F.col("r") + 1) / (F.col("ra") + size)) - F.log((F.col("o") + 1) / (F.col("oa") + size))).alias("llr"))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_mean: float = 0.45) -> DataFrame:
    """One row per input row: ``doc_id, base, spans``, arrays of ``start, end,
    kind, token`` in code points, ordered by start, then kind.

    ``base`` holds the pattern kinds; ``spans`` adds Markov tokens of 16 or more
    characters outside base spans with a mean log-likelihood ratio of at least
    ``least_mean`` per character.  Null text is empty.  Without samples of a
    class its model is uniform and the prior of the other decides; without
    random samples no token is added.  Repeated rows give equal rows; other
    columns are not read; an empty table gives no rows."""
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = F.col("text")
    found = base.select("doc_id", F.array_sort(F.concat(
        _places(t, ASSIGN, 0, 2, 6), _places(t, ACCESS, 1), _places(t, HEX, 2))).alias("base"),
        _places(t, CANDIDATE, 3).alias("tokens"))
    free = F.filter("tokens", lambda c: ~F.exists("base", lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"])))
    rows = written(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "base", free.alias("tokens")), "secrets")
    # labelled samples: keys by pattern, and words, numbers and names by pattern
    random = rows.select(F.explode("base").alias("s")).select(F.col("s.token").alias("token"), F.lit(True).alias("random"))
    marked = random.select(F.explode(F.regexp_extract_all("token", F.lit(ORDINARY), F.lit(0))).alias("token")).distinct()
    words = base.select(F.explode(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0))).alias("token")) \
        .groupBy("token").agg(F.count("*").alias("n")).join(marked, "token", "left_anti") \
        .filter(~F.col("token").rlike(HEX) & ~F.col("token").rlike(ACCESS))
    samples = random.groupBy("token", "random").agg(F.count("*").alias("n")) \
        .union(words.select("token", F.lit(False), "n"))
    model = written(markov(samples), "markov")
    # the model has at most ALPHABET squared rows
    token = rows.select("row", F.explode("tokens").alias("t")).select("row", "t.start", "t.end", "t.kind", "t.token")
    mean = _transitions(token.select("row", "start", "token")).join(F.broadcast(model), ["a", "b"]) \
        .groupBy("row", "start").agg(F.avg("llr").alias("mean")).filter(F.col("mean") >= least_mean)
    trained = not random.isEmpty()
    more = token.join(mean, ["row", "start"]).filter(F.lit(trained)).groupBy("row").agg(F.collect_list(F.struct(
        "start", "end", "kind", "token")).alias("more"))
    return rows.join(more, "row", "left").select("doc_id", "base", F.array_sort(F.concat(
        "base", F.coalesce("more", F.array().cast(f"array<{SPAN}>")))).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    kind = F.array(*[F.lit(k) for k in KINDS])
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", F.get(kind, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def number_of(spans: Column, kind: int) -> Column:
    """Number of spans of one kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
