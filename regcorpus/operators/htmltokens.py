"""HTML inside the row: tokens, elements and texts of a document as arrays.

A document becomes one array of tokens (tags, texts, comments); its elements
come from one fold over the tags, which keeps the open elements and closes them
by HTML's rules for optional end tags.  Everything is Spark SQL text over
higher-order functions, so a document is never exploded, shuffled or sorted, the
same text serves DataFrames and SQL functions, and no Python runs in tasks.

Fragments take and return SQL expressions.  ``let`` binds a value once: an
expression used inside a lambda would be evaluated for every element.
"""

from __future__ import annotations

import re
from html.entities import html5

# --- fixed values: element names -----------------------------------------------
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
BLOCK = ("address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main",
         "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul")
HEAD = ("html", "head", "title", "base", "link", "meta", "style", "script", "noscript", "template")
RAW = "script|style|noscript|template"
# groups of elements whose ends may be left out, and elements that fence them in
GROUPS = {"li": 1, "dt": 2, "dd": 2, "td": 4 | 128, "th": 4 | 128, "tr": 8, "thead": 16, "tbody": 16, "tfoot": 16, "p": 32,
          "ul": 64, "ol": 64, "menu": 64, "dl": 64, "caption": 128, "button": 128, "object": 128, "table": 256}
LI, DT, CELL, ROW, SECTION, P, LIST, FENCE, TABLE, BLOCK_BIT = 1, 2, 4, 8, 16, 32, 64, 128, 256, 512
# start tag: groups it ends, elements it does not reach beyond
ENDS = {"li": (LI | P, LIST | FENCE | TABLE), "dt": (DT | P, LIST | FENCE | TABLE), "dd": (DT | P, LIST | FENCE | TABLE),
        "td": (CELL, TABLE), "th": (CELL, TABLE), "tr": (ROW | CELL, TABLE), "thead": (SECTION | ROW | CELL, TABLE),
        "tbody": (SECTION | ROW | CELL, TABLE), "tfoot": (SECTION | ROW | CELL, TABLE), "caption": (0, 0), "html": (0, 0), "body": (0, 0)}
# end tags that stay inside a table; those of the others stay inside a cell as well
IN_TABLE = ("caption", "td", "th", "tr", "thead", "tbody", "tfoot")
THROUGH = ("table", "body", "html")
# ---------------------------------------------------------------------------------
WHOLE = rf"(?is)<!--.*?(?:-->|\z)|<({RAW})(?=[\s/>]).*?(?:</\1\s*>|\z)|<title(?=[\s/>])[^>]*>[^<]*(?:</title\s*>)?"
PIECE = r"""<[!?][^>]*(?:>|\z)|</?[a-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|</?[a-z][^>]*>|(?:[^<]++|<(?![a-z/!?]))++|<"""
TOKEN = f"{WHOLE}|{PIECE}"
# elements that cells of a plain row may hold: they end nothing and belong to no group
INLINE = ("a", "abbr", "b", "code", "em", "font", "i", "nobr", "small", "span", "strong", "sub", "sup", "u")
PLAIN = """(?:[^<>"']++|"[^"<>]*+")*+"""
TAG = "struct<i:int,open:boolean,tag:string,own:int,ends:int,stop:int,rule:string,mark:int,need:int>"
ENTRY = "struct<tag:string,own:int,start:int,rule:string,mark:int,row:int>"
ELEMENT = "struct<start:int,end:int,rule:string,row:int>"
CHUNK = 128


def lit(s: str) -> str:
    """A Spark SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``.  The finishing step of a fold
    over nothing: ``transform`` would copy the body's value, all of its arrays."""
    return f"aggregate(CAST(array() AS array<int>), {value}, (bound, none) -> bound, {name} -> {body})"


def among(value: str, names) -> str:
    return f"{value} IN ({', '.join(lit(n) for n in names)})"


def _tag_facts() -> str:
    """A map of tag name -> groups, what a start tag ends, how far start and
    end tags reach, and whether the element is void."""
    facts = []
    for tag in sorted({*BLOCK, *GROUPS, *ENDS, *VOID}):
        own = GROUPS.get(tag, 0) | (BLOCK_BIT if tag in BLOCK else 0)
        ends, stop = ENDS.get(tag, (P if tag in BLOCK else 0, FENCE | TABLE))
        back = 0 if tag in THROUGH else TABLE if tag in IN_TABLE else LIST | FENCE | TABLE if tag == "li" else FENCE | TABLE
        facts.append(f"{lit(tag)}, named_struct('own', {own}, 'ends', {ends}, 'stop', {stop}, 'back', {back}, 'void', {str(tag in VOID).lower()})")
    return f"map({', '.join(facts)})"


# --- texts -----------------------------------------------------------------------
def stripped(text: str) -> str:
    return rf"regexp_replace({text}, {lit('(?U)^\\s+|\\s+$')}, '')"


def squeezed(text: str) -> str:
    """White space runs as one space, none at the ends."""
    return rf"trim(regexp_replace({text}, {lit('(?U)\\s+')}, ' '))"


def decoded(text: str, bare: bool = True) -> str:
    """Character references resolved, unknown ones as they are; ``bare`` names
    without semicolon too (in texts, not in addresses)."""
    legacy = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    ref = r"&(#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?|[A-Za-z][A-Za-z0-9]*;" + ("|" + "|".join(legacy) if bare else "") + ")"

    def names(keep):
        table = "\x02".join(f"{n}\x03{html5[n + ';']}" for n in keep)
        return f"str_to_map({lit(table)}, {lit(chr(2))}, {lit(chr(3))})"

    rest = [n[:-1] for n in html5 if n.endswith(";") and n[:-1] not in html5]
    number = ("CASE WHEN n RLIKE '^#[xX]' THEN CAST(conv(substring(n, 3), 16, 10) AS bigint) "
              "WHEN n LIKE '#%' THEN CAST(substring(n, 2) AS bigint) END")
    valid = "c > 0 AND c <= 1114111 AND NOT c BETWEEN 55296 AND 57343"
    char = "decode(unhex(lpad(hex(c), 8, '0')), 'UTF-32')"
    known = f"coalesce(try_element_at({names(sorted(legacy))}, n), try_element_at({names(sorted(rest))}, n), concat('&', r))"
    value = let("n", "replace(r, ';', '')", let("c", number, f"CASE WHEN {valid} THEN {char} WHEN c IS NOT NULL THEN concat('&', r) ELSE {known} END"))
    refs = f"concat(transform(regexp_extract_all(w, {lit(ref)}, 1), r -> {value}), array(''))"
    return let("w", text, f"CASE WHEN contains(w, '&') THEN array_join(zip_with(split(w, {lit(ref)}, -1), {refs}, (g, r) -> concat(g, r)), '') ELSE w END")


def tokens(html: str, runs: str = "") -> str:
    """The tokens of an HTML text; with ``runs``, a ``plain_rows`` pattern, each
    run of plain table rows is one token."""
    return f"regexp_extract_all({html}, {lit(f'{WHOLE}|{runs}|{PIECE}' if runs else TOKEN)}, 0)"


def plain_rows(names) -> str:
    """A pattern, for ``tokens``, of consecutive table rows with the same start
    tag that hold nothing but cells of texts, line breaks and inline elements
    around a text; end tags of cells and, before a further row, of rows may be
    left out.  No tag in a row holds one of ``names``.

    Whatever is open, such a row ends what its start tag ends and leaves nothing
    open, so the rows of a run all meet the same open elements."""
    free = f"(?![^<>]*(?:{'|'.join(re.escape(n) for n in names)}))" if names else ""
    inline = rf"<({'|'.join(INLINE)})(?=[\s>]){free}{PLAIN}(?<!/)>[^<]*+</\3\s*>"
    cell = rf"<t[dh](?=[\s>]){free}{PLAIN}(?<!/)>(?:[^<]++|<br(?=[\s/>]){PLAIN}>|{inline})*+(?:</t[dh]\s*>)?+"
    rest = rf"\s*+(?:{cell}\s*+)*+(?:</tr\s*>|(?=<tr(?=[\s/>])[^>]*>))"
    return rf"(<tr(?=[\s>]){PLAIN}(?<!/)>){rest}(?:\s*+(?-i:\2){rest})*+"


def is_run(tok: str) -> str:
    """Whether a token is a run of plain rows, no single tag."""
    return f"{tok} RLIKE {lit(f'(?is)^<tr(?=[{chr(92)}s>]){PLAIN}>.')}"


def run_rows(run: str) -> str:
    """The rows of a run, as texts."""
    return f"regexp_extract_all({run}, {lit(r'(?i)<tr(?:[^<]++|<(?!tr))*+')}, 0)"


def run_tags(toks: str, runs: str, **kw) -> str:
    """``tags`` of tokens with runs (``runs``: which tokens are some), of any
    element: a run is one row's start and end tag, so its element ends at the
    token that starts it."""
    heads = f"zip_with({toks}, {runs}, (tok, run) -> CASE WHEN run THEN regexp_extract(tok, '^<[^>]*>', 0) ELSE tok END)"
    end = (f"named_struct('i', t.i, 'open', false, 'tag', t.tag, 'own', t.own, 'ends', 0, 'stop', {TABLE}, "
           "'rule', CAST(NULL AS string), 'mark', 0, 'need', 0)")
    return f"flatten(transform({tags(heads, every=True, **kw)}, t -> CASE WHEN get({runs}, t.i) THEN array(t, {end}) ELSE array(t) END))"


def is_text(tok: str) -> str:
    return f"({tok} = '<' OR {tok} NOT RLIKE {lit('^<[a-zA-Z/!?]')})"


def tag_name(tok: str) -> str:
    """Lower-case name of a tag; empty for anything else."""
    return f"lower(regexp_extract({tok}, {lit(f'^</?(?!(?i:title|{RAW})[\\s/>])([a-zA-Z][a-zA-Z0-9:-]*)')}, 1))"


def attribute(tok: str, name: str) -> str:
    """An attribute's value; null where it is absent."""
    found = f"nullif(regexp_extract({tok}, {lit(rf'''(?i)[\s"'/]{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)''')}, 1), '')"
    return f"regexp_replace({found}, {lit(r'''^["']|["']$''')}, '')"


def has_class(name: str) -> str:
    """Test on ``cls``, the class names with a space around each."""
    return f"contains(cls, {lit(f' {name} ')})"


# --- elements ----------------------------------------------------------------------
def tags(toks: str, rule: str, mark: str = "0", need: str = "0", first: tuple[str, ...] = (), every: bool = False) -> str:
    """The tags that shape the document, as an array of ``TAG``.

    ``rule`` names the elements to find, an expression over ``tag``, ``cls``,
    ``eid`` and ``tok``; ``mark`` is a bit set of an element and ``need`` the
    marks that must be open around one for its rule to hold.  Of a rule in
    ``first`` only the document's first element counts.  ``every`` lets any tag
    be an element, else only block-level ones (and those with a rule) are."""
    opens = "tok NOT LIKE '</%' AND NOT coalesce(m.void, false) AND tok NOT LIKE '%/>'"
    # most tags have no attribute
    cls = "CASE WHEN o AND contains(tok, '=') THEN concat(' ', " + squeezed(f"coalesce({attribute('tok', 'class')}, '')") + ", ' ') ELSE '' END"
    eid = f"CASE WHEN o AND contains(tok, '=') THEN coalesce({attribute('tok', 'id')}, '') ELSE '' END"
    made = (f"named_struct('i', i, 'open', o, 'tag', tag, 'own', coalesce(m.own, 0), 'ends', CASE WHEN tok LIKE '</%' THEN 0 ELSE coalesce(m.ends, 0) END, "
            f"'stop', coalesce(CASE WHEN tok LIKE '</%' THEN m.back ELSE m.stop END, {FENCE | TABLE}), "
            f"'rule', CASE WHEN o THEN {rule} END, 'mark', CASE WHEN o THEN {mark} ELSE 0 END, 'need', {need})")
    made = let("cls", cls, let("eid", eid, made) if re.search(r"\beid\b", rule + mark + need) else made)
    made = let("m", f"try_element_at({_tag_facts()}, tag)", let("o", opens, made))
    one = let("tag", tag_name("tok"), f"CASE WHEN tag <> '' THEN {made} END")
    all_tags = f"array_compact(transform({toks}, (tok, i) -> CASE WHEN tok LIKE '<%' THEN {one} END))"
    if first:
        head = ", ".join(f"get(filter(all, t -> t.rule = {lit(r)}), 0).i" for r in first)
        only = let("heads", f"array({head})", "transform(all, t -> CASE WHEN "
                   f"{among('t.rule', first)} AND NOT coalesce(array_contains(array_compact(heads), t.i), false) "
                   "THEN named_struct('i', t.i, 'open', t.open, 'tag', t.tag, 'own', t.own, 'ends', t.ends, 'stop', t.stop, "
                   "'rule', CAST(NULL AS string), 'mark', 0, 'need', t.need) ELSE t END)")
        all_tags = let("all", all_tags, only)
    if every:
        return all_tags
    # tags of other names only where some element of that name has a rule or a mark
    named = "array_distinct(transform(filter(all, t -> t.rule IS NOT NULL OR t.mark <> 0), t -> t.tag))"
    return let("all", all_tags, let("named", named, "filter(all, t -> t.own <> 0 OR array_contains(named, t.tag))"))


def elements(tag_array: str, size: str, free: tuple[str, ...] = ("root", "body"), choose: str | None = None, cuts: bool = False) -> str:
    """Elements with a rule, ``array<ELEMENT>`` in document order, ``end`` being
    the token that ends them (or ``size``).

    An element counts where no other counted one is open, those with a rule in
    ``free`` everywhere.  ``choose`` replaces this choice, an expression over the
    tag ``t``, the open elements ``rest`` (innermost first), ``counted`` (is one
    open) and ``marked`` (are the needed marks open).  ``cuts`` adds the
    block-level tags outside of all counted elements as ``cut``."""
    counted = f"exists(rest, e -> e.rule IS NOT NULL AND NOT {among('e.rule', free)})"
    marked = "(t.need = 0 OR exists(rest, e -> e.mark & t.need <> 0))"
    own = choose or f"CASE WHEN {among('t.rule', free)} THEN t.rule WHEN t.rule IS NOT NULL AND {marked} AND NOT {counted} THEN t.rule END"
    own = own.replace("{counted}", counted).replace("{marked}", marked)
    row = f"CASE WHEN r = 'cell' THEN get(filter(rest, e -> e.own & {ROW | TABLE} <> 0), 0).start END"
    pushed = let("r", own, f"concat(array(named_struct('tag', t.tag, 'own', t.own, 'start', t.i, 'rule', r, 'mark', t.mark, 'row', {row})), rest)")
    ended = "transform(filter(slice(a.stack, 1, k), e -> e.rule IS NOT NULL), e -> named_struct('start', e.start, 'end', t.i, 'rule', e.rule, 'row', e.row))"
    none = f"CAST(array() AS array<{ELEMENT}>)"
    cut = "array(named_struct('start', t.i, 'end', t.i + 1, 'rule', 'cut', 'row', CAST(NULL AS int)))"
    done = f"concat(found, CASE WHEN t.own & {BLOCK_BIT} <> 0 AND NOT {counted} THEN {cut} ELSE {none} END)" if cuts else "found"
    # how many of the open elements end: up to the farthest of a group within the fence, or up to the tag's own
    fence = "array_position(transform(a.stack, e -> e.own & t.stop <> 0), true)"
    farthest = let("near", f"CASE WHEN t.stop = 0 THEN 0 ELSE {fence} END",
                   let("scope", "transform(CASE WHEN near = 0 THEN a.stack ELSE slice(a.stack, 1, CAST(near - 1 AS int)) END, e -> e.own & t.ends <> 0)",
                       "CASE WHEN array_contains(scope, true) THEN size(scope) + 1 - array_position(reverse(scope), true) ELSE 0 END"))
    matching = let("at", "array_position(transform(a.stack, e -> e.tag = t.tag OR e.own & t.stop <> 0), true)",
                   "CASE WHEN at > 0 AND get(a.stack, CAST(at - 1 AS int)).tag = t.tag THEN at ELSE 0 END")
    ending = f"CAST(CASE WHEN t.ends <> 0 THEN {farthest} WHEN t.open THEN 0 ELSE {matching} END AS int)"
    after = let("rest", "CASE WHEN k = 0 THEN a.stack ELSE slice(a.stack, k + 1, greatest(size(a.stack) - k, 0)) END",
                let("found", f"CASE WHEN k = 0 THEN a.done ELSE concat(a.done, {ended}) END",
                    f"named_struct('stack', CASE WHEN t.open THEN {pushed} ELSE rest END, 'done', {done})"))
    inner = f"aggregate(chunk, named_struct('stack', s.stack, 'done', {none}), (a, t) -> {let('k', ending, after)})"
    outer = let("z", inner, "named_struct('stack', z.stack, 'parts', array_append(s.parts, z.done))")
    chunks = f"transform(sequence(0, greatest(size(tags) - 1, 0) DIV {CHUNK}), c -> slice(tags, CAST(c * {CHUNK} + 1 AS int), {CHUNK}))"
    left = f"transform(filter(s.stack, e -> e.rule IS NOT NULL), e -> named_struct('start', e.start, 'end', {size}, 'rule', e.rule, 'row', e.row))"
    fold = (f"aggregate({chunks}, named_struct('stack', CAST(array() AS array<{ENTRY}>), 'parts', CAST(array() AS array<array<{ELEMENT}>>)), "
            f"(s, chunk) -> {outer}, s -> array_sort(concat(flatten(s.parts), {left})))")
    return let("tags", tag_array, fold)


def flat(tag_array: str) -> str:
    """Whether no element with a rule holds another tag: the next tag is its end
    tag.  (Of the start tags only those of ``caption``, ``html`` and ``body`` end
    nothing; rules for these are not ``flat``'s.)"""
    after = f"get({tag_array}, n + 1)"
    closed = f"coalesce({after}.tag = t.tag AND {after}.ends = 0 AND NOT {after}.open, false)"
    return f"size(filter({tag_array}, (t, n) -> t.rule IS NOT NULL AND NOT {closed})) = 0"


def flat_segments(tag_array: str, size: str) -> str:
    """``array<struct<start, end, kind>>``: the tokens between block-level tags
    of a ``flat`` array, not empty, in order; ``kind`` is the rule of the element
    they fill, else empty."""
    starts = (f"concat(array(named_struct('start', -1, 'kind', '')), transform(filter({tag_array}, t -> t.own & {BLOCK_BIT} <> 0), "
              "t -> named_struct('start', t.i, 'kind', coalesce(t.rule, ''))))")
    ended = f"transform(x, (e, n) -> named_struct('start', e.start, 'end', coalesce(get(x, n + 1).start, {size}), 'kind', e.kind))"
    return let("x", starts, f"filter({ended}, e -> e.start + 1 < e.end)")


def head(toks: str) -> str:
    """The head as an element ``drop`` in an array (empty without one).  It ends
    at its end tag; where that is left out, at the first tag that cannot stand in
    it or the first text."""
    is_head = f"tok RLIKE {lit(r'(?i)^<head[ />' + chr(92) + 's]')}"
    name = f"CASE WHEN tok LIKE '<%' THEN {tag_name('tok')} ELSE '' END"
    leaves = let("tag", name, f"tag <> '' AND (tok LIKE '</%' OR NOT {among('tag', HEAD)})")
    text = f"{is_text('tok')} AND {stripped('tok')} <> ''"

    def first(test):
        return f"get(array_compact(transform(toks, (tok, i) -> CASE WHEN i > h AND ({test}) THEN i END)), 0)"

    tag_end = f"coalesce({first(leaves)}, size(toks))"
    end = let("e", tag_end, f"CASE WHEN get(toks, e) RLIKE '(?i)^</head' THEN e ELSE least(e, coalesce({first(text)}, e)) END")
    found = let("h", f"get(array_compact(transform(toks, (tok, i) -> CASE WHEN {is_head} THEN i END)), 0)",
                f"array(named_struct('start', h, 'end', {end}, 'rule', 'drop', 'row', CAST(NULL AS int)))")
    return let("toks", toks, f"CASE WHEN exists(toks, tok -> {is_head}) THEN {found} ELSE CAST(array() AS array<{ELEMENT}>) END")


def gaps(found: str, low: str, high: str) -> str:
    """``array<struct<start, end>>``: the tokens between ``low`` and ``high``
    (both left out) that lie in none of the disjoint elements ``found``; the
    token that ends an element is not part of it."""
    starts = f"concat(array({low}), transform(x, e -> e.end - 1))"
    ends = f"concat(transform(x, e -> e.start), array({high}))"
    return let("x", found, f"filter(zip_with({starts}, {ends}, (a, b) -> named_struct('start', a, 'end', b)), g -> g.start + 1 < g.end)")


def between(array: str, start: str, end: str) -> str:
    """The entries of a token-aligned array after ``start`` and before ``end``."""
    return f"slice({array}, {start} + 2, greatest({end} - {start} - 1, 0))"
