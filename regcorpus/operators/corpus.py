"""Corpus operators: citations, versions, graphs and reconciliations
(J5–J12, W3–W5, L5, X20, X21)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regcorpus.functions import extract as X
from regcorpus.operators.joins import group_facts, row_hash, small_dim

# --- fixed values: administrative court divisions (code, seat) -------------
COURT_DIVISIONS = [("Wa", "Warszawa"), ("Gl", "Gliwice"), ("Kr", "Krakow"), ("Wr", "Wroclaw"),
                   ("Po", "Poznan"), ("Gd", "Gdansk"), ("Bk", "Bialystok")]
# ---------------------------------------------------------------------------


def court_division(hits: DataFrame, spark: SparkSession, sig_col: str = "signature") -> DataFrame:
    """``SA/<code>`` of a signature resolved to the court seat; NULL
    city for signatures without a division (NSA)."""
    dim = small_dim(spark, COURT_DIVISIONS, "division string, city string")
    code = F.nullif(F.regexp_extract(F.col(sig_col), r"SA/(\w+)", 1), F.lit(""))
    return hits.withColumn("division", code).join(dim, "division", "left")


# --- fixed values: citation abbreviations (abbreviation, expansion) ---------
ABBREVIATIONS = [
    ("t.j.", "tekst jednolity"), ("zm.", "zmieniony"), ("art.", "artykul"), ("Art.", "artykul"),
    ("ust.", "ustep"), ("pkt", "punkt"), ("lit.", "litera"), ("zd.", "zdanie"), ("par.", "paragraf"),
    ("nb.", "numer brzegowy"), ("Rn.", "Randnummer"),
    ("u.b.z.z.", "ustawa o bezpieczenstwie zywnosci i zywienia"),
    ("u.PIS", "ustawa o Panstwowej Inspekcji Sanitarnej"),
    ("KPA", "Kodeks postepowania administracyjnego"),
    ("PPSA", "Prawo o postepowaniu przed sadami administracyjnymi"), ("Rozp.", "Rozporzadzenie"),
]
# What parts tokens
TOKEN_BREAK = "[\\s()\\[\\],;:\"'„”«»]+"
# Authority of a source (lower is stronger)
AUTHORITY_RANK = [("eu_regulation", 1), ("eu_directive", 2), ("eu_decision", 3), ("national_act", 4),
                  ("national_regulation", 5), ("cjeu", 6), ("nsa", 7), ("wsa", 8), ("efsa", 9),
                  ("soft_law", 10), ("doctrine", 11)]
# A provision of an EU act ("nr" is left out in newer citations), e.g. "Art. 9 ust. 1 lit. b) Rozp. (UE) nr 1169/2011"
PROVISION = (r"Art\.\s+(\d+[a-z]?)(?:\s+ust\.\s+(\d+))?(?:\s+pkt\s+(\d+))?(?:\s+lit\.\s+([a-z])\))?\s+"
             r"Rozp\.\s+\((?:UE|WE|EWG)\)\s+(?:nr\s+)?(\d{1,4}/\d{1,4})")
# The citation families (family, pattern)
CITATION_FAMILIES = [
    ("eu_provision", PROVISION),
    ("eu_annex", r"Zalacznik\s+[IVX]+\s+do\s+Rozp\.\s+\((?:UE|WE|EWG)\)\s+(?:nr\s+)?\d{1,4}/\d{1,4}"),
    ("eu_directive", r"[Dd]yrektyw\p{L}+\s+(?:\((?:UE|WE|EWG)\)\s+)?\d{2,4}/\d{1,4}(?:/(?:UE|WE|EWG))?"),
    ("celex", r"\b[03]\d{4}[RLD]\d{4}(?:-\d{8})?\b"),
    ("national_act", r"Dz\.U\.\s+(?:z\s+)?\d{4}\s+(?:r\.\s+)?poz\.\s+\d+"),
    ("national_provision", r"[Aa]rt\.\s+\d+[a-z]?(?:\s+ust\.\s+\d+)?(?:\s+pkt\s+\d+)?\s+(?:u\.b\.z\.z\.|u\.PIS|ustawy)"),
    ("cjeu", r"\b[CTF]-\d+/\d+(?:(?:,\s+[^,;\n]++)?,\s+ECLI:EU:[CTF]:\d{4}:\d+(?:,\s+pkt\s+\d+(?:-\d+)?)?)?"),
    ("administrative_court", r"(?:Wyrok|Uchwala|Postanowienie)\s+(?:NSA|WSA\s+w\s+\p{L}+)(?:\s+\(\d+\))?\s+z\s+\d{2}\.\d{2}\.\d{4},"
                             r"\s+sygn\.\s+[IVX]+\s+(?:[A-Z]{3}|SA/\p{L}{2})\s+\d+/\d{2}"),
    ("decision", r"Decyzja\s+(?:GIS|PPIS|PWIS)(?:\s+w\s+\p{L}+)?\s+z\s+\d{2}\.\d{2}\.\d{4}(?:,\s+znak:\s+[\w./-]*\w)?"),
    ("efsa", r"EFSA\s+Journal\s+\d{4};\d+\(\d+\):\d+"),
]
# ---------------------------------------------------------------------------


def entities(triples: DataFrame, predicates: list) -> DataFrame:
    """``(subject, po)``: each subject's distinct ``(predicate, object)`` pairs
    of the given predicates.  One scan and one exchange of the triples; every
    branch of a pattern reads this table."""
    # the joins ask for subjects that are not null; asked here, all branches share one exchange
    return triples.filter(F.col("predicate").isin(predicates) & F.col("subject").isNotNull()).groupBy("subject") \
        .agg(F.collect_set(F.struct("predicate", "object")).alias("po"))


def objects(predicate: str) -> Column:
    """The objects of one predicate of an entity."""
    return F.transform(F.filter("po", lambda x: x["predicate"] == predicate), lambda x: x["object"])


def work_pattern(triples: DataFrame, language: str, file_type: str | None = None, celex_p: str = "celex", date_p: str = "date",
                 belongs_p: str = "belongs_to", lang_p: str = "language", title_p: str = "title",
                 manifests_p: str = "manifests", type_p: str = "file_type") -> DataFrame:
    """The pattern celex -> work, work -> date, expression -> work,
    expression -> language and title, and with ``file_type`` OPTIONAL
    manifestation -> expression of that type: all matches ``(celex, date,
    expression, title, manifestation)``, distinct.

    A work without a date does not match; an expression without such a
    manifestation matches with NULL.  Conditional sets per subject, then one
    join per edge of the pattern."""
    optional = [manifests_p, type_p] if file_type else []
    e = entities(triples, [celex_p, date_p, belongs_p, lang_p, title_p, *optional])
    works = e.select(F.col("subject").alias("work"), F.explode(objects(celex_p)).alias("celex"), objects(date_p).alias("d")) \
        .select("work", "celex", F.explode("d").alias("date"))
    spoken = e.filter(F.exists("po", lambda x: (x["predicate"] == lang_p) & (x["object"] == language)))
    exprs = spoken.select(F.col("subject").alias("expression"), F.explode(objects(belongs_p)).alias("work"), objects(title_p).alias("t")) \
        .select("expression", "work", F.explode("t").alias("title"))
    rows = works.join(exprs, "work")
    if not file_type:
        return rows.select("celex", "date", "expression", "title", F.lit(None).cast("string").alias("manifestation")).distinct()
    typed = e.filter(F.exists("po", lambda x: (x["predicate"] == type_p) & (x["object"] == file_type)))
    files = typed.select(F.col("subject").alias("manifestation"), F.explode(objects(manifests_p)).alias("expression"))
    return rows.join(files, "expression", "left").select("celex", "date", "expression", "title", "manifestation").distinct()


def work_titles(triples: DataFrame, language: str, **predicates: str) -> DataFrame:
    """J5 with LIMIT 1 made deterministic: per celex the smallest title, then
    date, of the pattern's matches."""
    rows = work_pattern(triples, language, **predicates).select("celex", F.struct("title", "date").alias("r"))
    return rows.groupBy("celex").agg(F.min("r").alias("r")).select("celex", "r.*")


def reconcile(index: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Full outer join of an index with the files it lists; the NULL
    side is an orphan."""
    i = index.select(key).distinct().withColumn("_in_index", F.lit(True))
    f = files.select(key).distinct().withColumn("_in_files", F.lit(True))
    j = i.join(f, key, "full_outer")
    return j.select(key, F.coalesce("_in_index", F.lit(False)).alias("in_index"),
                    F.coalesce("_in_files", F.lit(False)).alias("in_files")).withColumn(
        "status", F.when(F.col("in_index") & F.col("in_files"), "ok")
        .when(F.col("in_index"), "missing_file").otherwise("not_indexed"))


def extract_provisions(df: DataFrame, text_col: str, keep=()) -> DataFrame:
    """Every EU-act provision cited in the text, one row each:
    ``article, paragraph, point, letter, act_number`` and the X8 ``celex``.

    The full provision pattern runs once per text; each found citation (a
    short string) is split with small anchored patterns in its own
    projection, then X8 runs on the extracted number."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(PROVISION), 0)
    rows = df.select(*keep, F.posexplode(found).alias("cit_no", "citation"))

    def part(p):
        return F.nullif(F.regexp_extract("citation", p, 1), F.lit(""))

    parts = rows.select(*keep, "cit_no", part(r"^Art\.\s+(\d+[a-z]?)").alias("article"),
                        part(r"\sust\.\s+(\d+)").alias("paragraph"),
                        part(r"\spkt\s+(\d+)").alias("point"),
                        part(r"\slit\.\s+([a-z])\)").alias("letter"),
                        part(r"\s(\d{1,4}/\d{1,4})$").alias("act_number"))
    return parts.withColumn("celex", X.celex_from_citation(F.col("act_number")))


def extract_citations(df: DataFrame, text_col: str, keep=()) -> DataFrame:
    """Every citation of every family, ``(keep..., family, cit_no,
    citation)``; each family's pattern runs once over the text."""
    found = F.array(*[F.struct(F.lit(name).alias("family"), F.regexp_extract_all(F.col(text_col), F.lit(p), F.lit(0)).alias("c"))
                      for name, p in CITATION_FAMILIES])
    each = df.select(*keep, F.explode(found).alias("f")).select(*keep, F.col("f.family").alias("family"), F.col("f.c").alias("c"))
    return each.select(*keep, "family", F.posexplode("c").alias("cit_no", "citation"))


# U4: what a file of each kind must hold (fixed values)
REQUIRED_PARTS = {
    "act": ("celex", "tytul_pl", "tytul_en", "dziennik_urzedowy", "data_wejscia", "ostatnia_konsolidacja", "link_eurlex"),
    "skill": ("Definicja roli", "Kluczowe przepisy", "Typowe pytania", "Metodologia", "Wymagania cytowania", "Pulapki"),
    "ruling": ("Sygnatura", "Data", "Sklad orzekajacy", "Teza", "Kluczowe fragmenty uzasadnienia", "Przepisy"),
}


def missing_parts(df: DataFrame, kind: str, text_col: str, keep=()) -> DataFrame:
    """U4/H9: ``(keep..., part)`` for every required part a file lacks: a
    front-matter key of an act, a heading or ``**name**`` mark of a skill or
    ruling (case does not matter)."""
    def has(part: str):
        name = part.replace("_", "[_ ]")
        shape = rf"(?m)^{name}:[ \t]*\S" if kind == "act" else rf"(?im)^(?:#{{1,6}}\s+(?:\d+\.\s+)?|(?:[-*]|\d+\.)\s+)?(?:\*\*)?{name}\b"
        return F.col(text_col).rlike(shape)
    gaps = F.array(*[F.when(~F.coalesce(has(p), F.lit(False)), F.lit(p)) for p in REQUIRED_PARTS[kind]])
    return df.select(*keep, F.explode(F.array_compact(gaps)).alias("part"))


# H9: the sections of a case file by collection, in order (fixed values)
SECTION_SETS = {
    "nsa": ("Teza", "Stan faktyczny", "Uzasadnienie", "Znaczenie dla praktyki prawa zywnosciowego", "Powolane przepisy", "Cytowanie"),
    "wsa": ("Teza", "Stan faktyczny", "Uzasadnienie", "Znaczenie dla praktyki prawa zywnosciowego", "Powolane przepisy", "Cytowanie"),
    "tsue": ("Teza", "Stan faktyczny i pytania prejudycjalne", "Rozstrzygniecie", "Uzasadnienie", "Znaczenie dla prawa zywnosciowego",
             "Powolane przepisy", "Cytowanie"),
    "gis": ("Przedmiot sprawy", "Ustalenia", "Rozstrzygniecie", "Uzasadnienie", "Znaczenie praktyczne", "Podstawa prawna", "Cytowanie"),
}


def section_check(files: DataFrame, kind_col: str, text_col: str, keep=()) -> DataFrame:
    """H9: the ``##`` sections of every file against the set of its collection:
    ``(keep..., kind, n_sections, missing, unexpected, repeated, in_order)``.

    Relational division inside the row: what the set has and the file lacks, and
    the reverse; ``in_order`` compares the sections both have, in either order
    of listing.  Unknown collections have an empty set; a null text has no
    sections."""
    required = F.coalesce(F.try_element_at(F.create_map(*[x for k, v in SECTION_SETS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]),
                                           F.coalesce(F.col(kind_col), F.lit(""))), F.array().cast("array<string>"))
    body = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"(?ms)^(```|~~~).*?^\1", "")
    rows = files.select(*keep, F.col(kind_col).alias("kind"), required.alias("r"),
                        F.transform(F.regexp_extract_all(body, F.lit(r"(?m)^##[ \t]+(.*?)[ \t#]*$"), F.lit(1)), F.trim).alias("s"))
    own, other = F.array_distinct("s"), F.col("r")
    return rows.select(*keep, "kind", F.size("s").alias("n_sections"), F.array_except(other, own).alias("missing"), F.array_except(own, other).alias("unexpected"),
                       (F.size("s") > F.size(own)).alias("repeated"), (F.array_intersect(own, other) == F.array_intersect(other, own)).alias("in_order"))


def resolve_acts(citations: DataFrame, acts: DataFrame, key: str = "celex") -> DataFrame:
    """Citations joined to the act table (left: unresolved keep NULLs)."""
    return citations.join(acts, key, "left")


def expand_abbreviations(df: DataFrame, text_col: str, spark: SparkSession, keep=()) -> DataFrame:
    """Tokens that are known abbreviations, with expansion (fixed 16-row
    dimension, broadcast).  White space, brackets, quotes, commas, semicolons
    and colons part tokens, so ``(t.j.)`` and ``KPA,`` count."""
    dim = small_dim(spark, ABBREVIATIONS, "token string, expansion string")
    toks = df.select(*keep, F.explode(F.split(F.col(text_col), TOKEN_BREAK)).alias("token"))
    return toks.join(dim, "token")


def link_graph(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Per node in/out degree and outgoing edges without a reverse edge.

    One pass over the distinct edges: a window over the unordered node pair
    (at most two rows: a->b and b->a) tells whether the reverse exists, then
    each edge explodes into (src: out, dst: in) contributions summed per node.
    No self-join, so the edge input is computed once."""
    e = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct()
    pair = Window.partitionBy(F.least("src", "dst"), F.greatest("src", "dst"))
    e = e.withColumn("_non_recip", (F.count("*").over(pair) == 1) & (F.col("src") != F.col("dst")))
    contrib = F.explode(F.array(
        F.struct(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i"),
                 F.col("_non_recip").cast("int").alias("nr")),
        F.struct(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"), F.lit(0).alias("nr"))))
    c = e.select(contrib.alias("c")).select("c.*")
    return c.groupBy("node").agg(F.sum("i").cast("long").alias("in_degree"), F.sum("o").cast("long").alias("out_degree"),
                                 F.sum("nr").cast("long").alias("non_reciprocal_out"))


GRAM = 4


def word_postings(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """J9's index: ``(word, id)``, each document's distinct lower-case words
    (stretches without white space)."""
    words = F.array_distinct(F.split(F.lower(F.col(text_col)), r"\s+"))
    # explode_outer: explode would push a copy of the array below the projection and build it twice
    return docs.select(F.col(id_col).alias("id"), F.explode_outer(words).alias("word")).filter("word <> ''").select("word", "id")


def append_postings(postings: DataFrame, table: str, path: str, buckets: int = 64) -> None:
    """A wave of postings appended to the kept index, a table in buckets by
    word, sorted inside: a search reads it without shuffling it, given no fewer
    buckets than shuffle partitions.  Waves hold different documents;
    ``merge_postings`` rewrites many waves' files as one."""
    writer = postings.repartition(buckets, "word").write.mode("append").bucketBy(buckets, "word").sortBy("word")
    writer.option("path", path).format("parquet").saveAsTable(table)


def merge_postings(spark: SparkSession, table: str, merged: str, path: str, buckets: int = 64) -> None:
    """All waves of an index as a new one with one file per bucket; rows
    that several waves hold are kept once."""
    append_postings(spark.table(table).dropDuplicates(["word", "id"]), merged, path, buckets)


def _grams(words: DataFrame, gram: int) -> DataFrame:
    """``(word, _g)``: the character grams of 1 to ``gram`` characters of every
    word; a gram that a word repeats is a row each time."""
    ahead = F.lit(f"(?s)(?=(.{{{gram}}})).")
    padded = F.concat("word", F.lit("\u0000" * (gram - 1)))
    whole = words.select("word", F.explode_outer(F.regexp_extract_all(padded, ahead, F.lit(1))).alias("_w"))
    return whole.select("word", F.explode_outer(F.array("_w", *[F.substring("_w", 1, n) for n in range(1, gram)])).alias("_g"))


def phrase_hits(docs: DataFrame, phrases: DataFrame, text_col: str = "text", phrase_col: str = "phrase", id_col: str = "doc_id",
                gram: int = GRAM, postings: DataFrame | None = None) -> DataFrame:
    """(phrase, document) for every case-insensitive substring match; a
    document appears once per matching phrase (no de-duplication across
    phrases); empty and null phrases, and those of white space alone, match
    nothing.

    A phrase without white space lies inside one word, so it is looked up in the
    corpus's distinct words, by the one of its character grams that the fewest
    words hold, and carried to the documents by the word postings: texts are not
    read again.  Of other phrases the longest word is looked up this way, and
    the documents found are verified by their text.  ``postings`` is a kept
    index (``word_postings`` of the same documents)."""
    held_words = word_postings(docs, text_col, id_col) if postings is None else postings
    parts = F.filter(F.split("_p", r"\s+"), lambda w: w != "")
    p = phrases.select(F.lower(F.col(phrase_col)).alias("_p")).distinct().withColumn("_parts", parts).filter("size(_parts) > 0")
    p = p.select("_p", F.xxhash64("_p").alias("_k"), F.array_max(F.transform("_parts", lambda w: F.struct(F.length(w), w.alias("w"))))["w"].alias("_w"),
                 F.col("_p").rlike(r"\s").alias("_many"))
    # every place looks ahead ``gram`` characters and moves on by one
    own = F.when(F.length("_w") <= gram, F.array("_w")).otherwise(F.array_distinct(F.regexp_extract_all("_w", F.lit(f"(?s)(?=(.{{{gram}}})).") , F.lit(1))))
    wanted = p.select("_k", "_w", F.explode(own).alias("_g"))
    vocabulary = held_words.select("word").distinct()
    in_words = _grams(vocabulary, gram).join(wanted.select("_g").distinct(), "_g", "left_semi")
    often = in_words.groupBy("_g").agg(F.count("*").alias("_df"))
    # a phrase with a gram that no word holds is nowhere
    rarest = wanted.join(often, "_g", "left").groupBy("_k", "_w").agg(F.min(F.struct(F.coalesce("_df", F.lit(0)).alias("_df"), "_g")).alias("m")) \
        .filter("m._df > 0").select("_k", "_w", F.col("m._g").alias("_g"))
    matched = in_words.join(rarest, "_g").filter(F.col("word").contains(F.col("_w"))).groupBy("word").agg(F.collect_list("_k").alias("_ks"))
    found = held_words.join(matched, "word").groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("_ks"))).alias("_ks"))
    hits = found.select("id", F.explode("_ks").alias("_k")).join(p.select("_k", "_p", "_many"), "_k")
    alone = hits.filter("NOT _many").select(F.col("_p").alias(phrase_col), F.col("id").alias(id_col))
    if p.filter("_many").isEmpty():
        return alone
    texts = docs.select(F.col(id_col).alias("id"), F.lower(F.col(text_col)).alias("_t"))
    many = hits.filter("_many").join(texts, "id").filter(F.col("_t").contains(F.col("_p"))).select(F.col("_p").alias(phrase_col), F.col("id").alias(id_col))
    return alone.unionByName(many)


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys only on the left and keys only on the right (anti joins)."""
    l_ = left.select(key).distinct()
    r_ = right.select(key).distinct()
    return (l_.join(r_, key, "left_anti").withColumn("side", F.lit("left_only"))
            .unionByName(r_.join(l_, key, "left_anti").withColumn("side", F.lit("right_only"))))


def version_validity(versions: DataFrame, key: str, valid_from: str = "valid_from") -> DataFrame:
    """``valid_to`` = the next version's ``valid_from`` for the same key
    (NULL for the newest version).

    Two levels, so no window spans all versions of a key: within a
    (key, month) bucket ``lead`` gives the next version; the last version of
    a bucket takes the first ``valid_from`` of the key's next non-empty
    bucket, found by a window over the bucket table (one row per key and
    month).  The buckets come from the same exchange as the versions."""
    v = versions.withColumn("_b", _month(F.col(valid_from))).repartition(key, "_b")
    inner = Window.partitionBy(key, "_b").orderBy(valid_from)
    buckets = group_facts(v, [key, "_b"], _first=F.min(valid_from))
    buckets = buckets.withColumn("_next_b", F.lead("_first").over(Window.partitionBy(key).orderBy("_b"))).drop("_first")
    return (v.withColumn("_next_in", F.lead(valid_from).over(inner)).join(buckets, [key, "_b"])
            .withColumn("valid_to", F.coalesce("_next_in", "_next_b"))
            .drop("_b", "_next_in", "_next_b"))


def _month(c):
    return (F.year(c) * 12 + F.month(c) - 1).cast("int")


def as_of(samples: DataFrame, versions: DataFrame, key: str, date_col: str,
          valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Each sample joined to the newest version of its key that began on
    or before its date; NULLs before the first version, and where that version
    has ended (``valid_to``, if the versions have it, on or before the date).
    Samples without key or date have no version.

    A merge of both sides: they are dealt out together by (key, month), and in a
    bucket the last version seen is carried on in date order; the version that a
    bucket starts with is the newest of the key's earlier buckets, from a window
    over the bucket table (one row per key and month).  Each side is read and
    moved once, and a hot key is spread over its months."""
    vcols = [c for c in versions.columns if c != key]
    v = F.struct(F.col(valid_from).alias("_at"), *[F.col(c).alias(c) for c in vcols])
    began = versions.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("_k"), F.col(valid_from).alias("_d"), F.lit(0).alias("_side"), v.alias("_v"))
    asked = samples.select(F.col(key).alias("_k"), F.col(date_col).alias("_d"), F.lit(1).alias("_side"), *[F.col(c).alias(f"_s_{c}") for c in samples.columns])
    both = began.unionByName(asked, allowMissingColumns=True).withColumn("_m", _month(F.col("_d")))
    # samples without key or date match nothing: they are dealt by their values
    lone = F.when((F.col("_side") == 1) & (F.col("_k").isNull() | F.col("_d").isNull()), row_hash(both))
    dealt = both.withColumn("_lone", lone).repartition("_k", "_m", "_lone")
    earlier = Window.partitionBy("_k").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    buckets = group_facts(dealt, ["_k", "_m", "_lone"], _last=F.max("_v")).filter("_lone IS NULL") \
        .withColumn("_before", F.max("_last").over(earlier)).select(F.col("_k").alias("_bk"), F.col("_m").alias("_bm"), "_before")
    # the row's hash as last order key: both uses of the rows ask for all columns and share their exchange
    so_far = Window.partitionBy("_k", "_m", "_lone").orderBy("_d", "_side", "_row").rowsBetween(Window.unboundedPreceding, 0)
    seen = dealt.withColumn("_row", row_hash(dealt)).withColumn("_own", F.max("_v").over(so_far)).filter("_side = 1")
    j = seen.join(buckets, (F.col("_k") == F.col("_bk")) & (F.col("_m") == F.col("_bm")) & F.col("_lone").isNull(), "left")
    found = j.withColumn("_f", F.when(F.col("_lone").isNull(), F.coalesce("_own", "_before")))
    if valid_to in vcols:
        found = found.withColumn("_f", F.when(F.col(f"_f.{valid_to}").isNull() | (F.col("_d") < F.col(f"_f.{valid_to}")), F.col("_f")))
    return found.select(*[F.col(f"_s_{c}").alias(c) for c in samples.columns], *[F.col(f"_f.{c}").alias(c) for c in vcols])


def latest_by(df: DataFrame, key: str, order_cols: list) -> DataFrame:
    """The row with the greatest ``order_cols`` per key (``max`` over a
    struct: partial aggregation, no window)."""
    other = [c for c in df.columns if c != key]
    packed = F.struct(*[F.col(c) for c in order_cols], *[F.col(c).alias(f"_{c}") for c in other])
    return df.groupBy(key).agg(F.max(packed).alias("_w")).select(
        key, *[F.col(f"_w._{c}").alias(c) for c in other])


def authority_rank(df: DataFrame, kind_col: str, spark: SparkSession) -> DataFrame:
    """Authority rank of each source kind (EU > national > CJEU > NSA >
    WSA > EFSA > soft law > doctrine); unknown kinds rank last."""
    dim = small_dim(spark, AUTHORITY_RANK, "_kind string, authority int")
    return df.join(dim, df[kind_col] == dim["_kind"], "left").drop("_kind").withColumn(
        "authority", F.coalesce("authority", F.lit(99)))
