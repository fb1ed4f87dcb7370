"""Operator 4, main text of web pages by a recurrent block labeller.

A page is read once into leaf blocks: the text between block-level tags, with
its path of open tags.  Every block becomes a vector of hashed tag-path names,
hashed words and a few numbers; a bidirectional LSTM (numpy) reads the blocks
of a page in both directions and labels each with the whole document as
context.  Blocks labelled as main text are joined.

The labeller is trained here, on a bounded sample of pages (``sample`` pages by
hash of the id, each of at most ``max_html`` characters, of long ones the outer
``MAX_BLOCKS`` blocks) whose blocks are
labelled by the sectioning elements and class names that say what they are;
each sampled page is seen a second time without those names, so that context
and words must tell.  The model has a fixed size and travels with the tasks.
Every page of the table is then labelled whole, in one pass without a shuffle.
When no page could be sampled, the blocks are labelled by those elements and
names themselves.
"""

from __future__ import annotations

import html as entities
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH_DIMS, WORD_DIMS, HIDDEN = 32, 32, 16
INPUT = PATH_DIMS + WORD_DIMS + 5
SAMPLE, MAX_HTML, MAX_BLOCKS, STEPS = 150, 200_000, 150, 1 << 15

# Fixed names of HTML elements.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table
tbody td tfoot th thead title tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = "script|style|noscript|template|textarea|iframe|title"
# ordinary elements whose own text is left out when they are closed
LEFT_OUT_TAGS = frozenset(("svg", "select", "object", "button"))
CONTENT_TAGS = frozenset(("article", "main"))
OTHER_TAGS = frozenset(("nav", "footer", "aside", "form", "menu", "dialog"))
OTHER_NAMES = re.compile(r"(?i)(^|[-_ ])(ad|ads|advert\w*|banner|breadcrumb\w*|comment\w*|cookie\w*|consent|foot\w*|head\w*|menu\w*|nav\w*|"
                         r"newsletter|notice\w*|pager|popup|promo\w*|related|repl(y|ies)|share|sidebar|social|sponsor\w*|subscribe|widget)($|[-_ ])")
# which open element a start tag ends, and how far up it looks
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
P_STOPS = LEFT_OUT_TAGS | {"td", "th", "table", "caption"}

TOKEN = re.compile(rf"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)
|<(?P<raw>{RAW_TAGS})(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>
|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
|<(?P<close2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)[^>]*+>""", re.S | re.I | re.X)
RAW_ENDS = {(tag, svg): re.compile(rf"</(?:{tag}{'|(?P<svg>svg)' if svg else ''})\s*>", re.I) for tag in RAW_TAGS.split("|") for svg in (False, True)}
NAMES = re.compile(r"""(?i)(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""")


class Block:
    """A leaf block with the state of its tag path."""

    __slots__ = ("text", "path", "linked", "depth", "tag", "content", "other")

    def __init__(self, text, path, linked, depth, tag, content, other):
        self.text, self.path, self.linked, self.depth = text, path, linked, depth
        self.tag, self.content, self.other = tag, content, other


def joined(a: list, b: list) -> list:
    """``a + b`` in the longer of the two lists."""
    if len(a) < len(b):
        b[:0] = a
        return b
    a.extend(b)
    return a


def leaf_blocks(page: str, named: bool = True) -> list[Block]:
    """Leaf blocks in page order.  The path is a running sum over the open
    elements, so depth costs nothing.  Without ``named``, sectioning elements
    and class names do not enter the path.

    The text of a left-out element is set aside until its end tag drops it; of
    an element that never meets its end tag it stays."""
    out: list[Block] = []
    stack: list[tuple] = []
    path = np.zeros(PATH_DIMS, np.float32)
    parts: list[str] = []
    linked = links = content = other = svgs = 0
    cut = False  # whether a block ended since the innermost left-out element
    aside: list[tuple] = []  # what was read before each open left-out element

    def mark(name: str, step: int) -> None:
        h = crc32(name.encode())
        path[h % PATH_DIMS] += step if h >> 16 & 1 else -step

    def flush() -> None:
        nonlocal linked, cut
        cut = True
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, path.copy(), linked, len(stack), stack[-1][0] if stack else "", content, other))
            parts.clear()
        linked = 0

    def pop(ended: bool = False) -> None:
        nonlocal links, content, other, svgs
        tag, names, is_content, is_other = stack.pop()
        for name in names:
            mark(name, -1)
        links -= tag == "a"
        content -= is_content
        other -= is_other
        svgs -= tag == "svg"
        if tag in LEFT_OUT_TAGS:
            back(ended)

    def back(drop: bool) -> None:
        nonlocal out, parts, linked, cut
        inner, inner_parts, inner_linked, inner_cut = out, parts, linked, cut
        out, parts, linked, cut = aside.pop()
        if not drop:
            if inner_cut:
                flush()
            out, parts = joined(out, inner), joined(parts, inner_parts)
            linked += inner_linked

    at = 0
    while m := TOKEN.search(page, at):
        if m.start() > at:
            parts.append(page[at:m.start()])
            if links:
                linked += m.start() - at
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if m["raw"]:
            # inside svg such an element may close itself and ends with the svg
            name = m["raw"].lower()
            if not (svgs and m[0].endswith("/>")):
                end = RAW_ENDS[name, svgs > 0].search(page, at)
                at = len(page) if not end else end.start() if svgs and end["svg"] else end.end()
            if name in BLOCK_TAGS:
                flush()
            continue
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
        if m["close"] or m["close2"]:
            # an inline end tag does not reach across a block element
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    while len(stack) > i:
                        pop(len(stack) == i + 1)
                    break
                if tag not in BLOCK_TAGS and tag not in LEFT_OUT_TAGS and stack[i][0] in BLOCK_TAGS:
                    break
            continue
        if tag in BLOCK_TAGS:
            for ended, stops in (({"p"}, P_STOPS), ENDS.get(tag, (None, None))):
                for i in range(len(stack) - 1, -1, -1) if ended else ():
                    if stack[i][0] in ended:
                        while len(stack) > i:
                            pop()
                        break
                    if stack[i][0] in stops or (ended == {"p"} and stack[i][0] in BLOCK_TAGS):
                        break
        if tag in VOID_TAGS or (m[0].endswith("/>") and (svgs or tag == "svg")):
            continue
        attrs = m["attrs"] or ""
        names = [x for g in NAMES.findall(attrs) for x in "".join(g).split()] if "=" in attrs else []
        is_other = tag in OTHER_TAGS or (tag == "header" and not content) or any(OTHER_NAMES.search(x) for x in names)
        is_content = tag in CONTENT_TAGS
        shown = [tag, *(f"{tag}.{x}" for x in names)] if named else [] if is_content or is_other or tag in ("header", "section") else [tag]
        for name in shown:
            mark(name, 1)
        stack.append((tag, shown, is_content, is_other))
        links += tag == "a"
        content += is_content
        other += is_other
        svgs += tag == "svg"
        if tag in LEFT_OUT_TAGS:
            aside.append((out, parts, linked, cut))
            out, parts, linked, cut = [], [], 0, False
    if at < len(page):
        parts.append(page[at:])
    while aside:
        back(False)
    flush()
    return out


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block: path, words, numbers."""
    x = np.zeros((len(blocks), INPUT), np.float32)
    for i, b in enumerate(blocks):
        x[i, :PATH_DIMS] = b.path
        words = b.text.split(" ")
        h = np.fromiter((crc32(w.encode()) for w in words), np.int64, len(words))
        v = np.bincount(h % WORD_DIMS, (h >> 16 & 1) * 2.0 - 1, WORD_DIMS)
        x[i, PATH_DIMS:PATH_DIMS + WORD_DIMS] = v / (np.sqrt(v @ v) + 1e-6)
        x[i, -5:] = (np.log1p(len(b.text)) / 5, min(1.0, b.linked / len(b.text)), b.depth / 10, b.text[-1] in ".!?", i / len(blocks))
    return np.clip(x, -4, 4)


def weak_labels(blocks: list[Block]) -> np.ndarray:
    """1 for main text: inside an article and nothing else; on pages without
    one, long blocks with few links outside other elements."""
    if any(b.content for b in blocks):
        return np.array([bool(b.content) and not b.other for b in blocks], np.float32)
    return np.array([not b.other and len(b.text) >= 80 and b.linked < 0.3 * len(b.text) for b in blocks], np.float32)


class Labeller:
    """Bidirectional LSTM with a logistic output per block."""

    def __init__(self, seed: int = 4):
        self.trained = False
        rng = np.random.default_rng(seed)
        self.p = {}
        for d in ("f", "b"):
            self.p[f"x{d}"] = rng.normal(0, 1 / np.sqrt(INPUT), (INPUT, 4 * HIDDEN)).astype(np.float32)
            self.p[f"h{d}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN:2 * HIDDEN] = 1
            self.p[f"c{d}"] = bias
        self.p["o"] = rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32)
        self.p["ob"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """Hidden states ``(time, page, hidden)`` of one direction; padding
        keeps the state of the last real block."""
        steps = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
        gates_x = x @ self.p[f"x{d}"] + self.p[f"c{d}"]
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        c, out, saved = h, np.zeros((*x.shape[:2], HIDDEN), np.float32), []
        for t in steps:
            z = gates_x[t] + h @ self.p[f"h{d}"]
            s = 1 / (1 + np.exp(-z[:, :3 * HIDDEN]))
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            if keep:
                saved.append((t, i, f, o, g, c, tc, h, m))
            c = m * c_new + (1 - m) * c
            h = m * (o * tc) + (1 - m) * h
            out[t] = h
        return out, saved

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Log-odds ``(time, page)``."""
        both = np.concatenate([self._run(x, mask, d, False)[0] for d in ("f", "b")], axis=2)
        return both @ self.p["o"] + self.p["ob"]

    def gradient(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean logistic loss by back-propagation through time."""
        runs = {d: self._run(x, mask, d, True) for d in ("f", "b")}
        both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        err = (1 / (1 + np.exp(-(both @ self.p["o"] + self.p["ob"]))) - y) * mask / max(1.0, float(mask.sum()))
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["o"] = np.tensordot(err, both, ([0, 1], [0, 1]))
        grad["ob"][0] = err.sum()
        for n, d in enumerate(("f", "b")):
            w = self.p["o"][n * HIDDEN:(n + 1) * HIDDEN]
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, i, f, o, g, c, tc, h, m in reversed(runs[d][1]):
                dh = dh + err[t][:, None] * w
                live = dh * m
                d_c = live * o * (1 - tc * tc) + dc * m
                dz = np.concatenate([d_c * g * i * (1 - i), d_c * c * f * (1 - f), live * tc * o * (1 - o), d_c * i * (1 - g * g)], axis=1)
                grad[f"x{d}"] += x[t].T @ dz
                grad[f"h{d}"] += h.T @ dz
                grad[f"c{d}"] += dz.sum(axis=0)
                dh = dz @ self.p[f"h{d}"].T + dh * (1 - m)
                dc = d_c * f + dc * (1 - m)
        return grad

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 14, rate: float = 0.02, batch: int = 32) -> Labeller:
        """Adam over batches of pages of like length."""
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        order = sorted(range(len(pages)), key=lambda i: (len(pages[i]), i))
        batches = []
        for a in range(0, len(order), batch):
            x, mask = padded([pages[i] for i in order[a:a + batch]])
            y = np.zeros(mask.shape, np.float32)
            for k, i in enumerate(order[a:a + batch]):
                y[:len(labels[i]), k] = labels[i]
            batches.append((x, mask, y))
        rng, step = np.random.default_rng(4), 0
        for _ in range(epochs):
            for at in rng.permutation(len(batches)):
                step += 1
                grad = self.gradient(*batches[at])
                for k, v in self.p.items():
                    a, b = moments[k]
                    a += 0.1 * (grad[k] - a)
                    b += 0.001 * (grad[k] ** 2 - b)
                    v -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
        self.trained = True
        return self

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is main text.  Pages of like length
        are padded together; a batch holds a bounded number of blocks."""
        out = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        a = 0
        while a < len(order):
            b = a + 1
            while b < len(order) and (b - a + 1) * len(pages[order[b]]) <= STEPS:
                b += 1
            x, mask = padded([pages[i] for i in order[a:b]])
            s = self.scores(x, mask)
            for k, i in enumerate(order[a:b]):
                out[i] = s[:len(pages[i]), k] > 0
            a = b
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(len(p) for p in pages)
    x = np.zeros((longest, len(pages), INPUT), np.float32)
    mask = np.zeros((longest, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[:len(p), k], mask[:len(p), k] = p, 1
    return x, mask


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE, max_html: int = MAX_HTML) -> Labeller:
    """A labeller trained on a bounded sample; an empty sample, as of a table of
    pages above ``max_html`` only, leaves the untrained one."""
    rows = pages.select(F.col(id_col).cast("bigint").alias("i"), F.col(html_col).alias("h"))
    # a threshold on the hash lets about twice the sample through, so no more is sent to be sorted
    chosen = F.pmod(F.xxhash64("i", F.lit(41)), F.lit(1 << 20)) < min(1 << 20, ((2 * sample) << 20) // max(1, rows.count()) + 1)
    got = rows.filter(chosen).filter(F.length("h") <= max_html).orderBy(F.xxhash64("i", F.lit(4)), "i", "h").limit(sample).collect()
    xs, ys = [], []
    for row in got:
        for named in (True, False):
            blocks = leaf_blocks(row["h"], named)
            # a sampled page trains with its first and last blocks when it is long
            part = np.r_[:len(blocks)] if len(blocks) <= MAX_BLOCKS else np.r_[:MAX_BLOCKS // 2, len(blocks) - MAX_BLOCKS // 2:len(blocks)]
            if blocks:
                xs.append(features(blocks)[part])
                ys.append(weak_labels(blocks)[part])
    return Labeller().fit(xs, ys) if xs else Labeller()


def extract(pages: DataFrame, labeller: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars``.  An untrained
    labeller is not asked; ``weak_labels`` decide in its place.

    Blocks labelled as main text, in page order, joined by two line ends; null
    or empty html gives the empty text.  Broken markup never fails: what is
    not a tag is text.  Repeated rows give equal rows; other columns are not
    read; an empty table gives no rows."""
    def run(batches):
        for b in batches:
            for at in range(0, max(1, b.num_rows), 256):
                part = b.slice(at, 256)
                blocks = [leaf_blocks(h.as_py() or "") for h in part.column(2)]
                chosen = labeller.label([features(p) for p in blocks]) if labeller.trained else [weak_labels(p) > 0 for p in blocks]
                texts = ["\n\n".join(x.text for x, yes in zip(p, c, strict=True) if yes) for p, c in zip(blocks, chosen, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")) \
        .mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
