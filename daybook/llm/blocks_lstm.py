"""Main text of web pages by a recurrent block labeller.

A page is read as the sequence of its leaf blocks. A bidirectional LSTM in numpy sees each block's
tag path and words as vectors and labels every block in the context of the whole page. It is
trained here, on labels that the names of enclosing elements suggest.
"""

from __future__ import annotations

import pickle
import re
import zlib
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.stage import sampled
from daybook.llm.text import Words, pieces

#: The model is fitted on at most so many windows, of so many blocks, out of the pages of least hash,
#: as many pages at most. Of a block in them, so many characters count.
SAMPLE = 300
WINDOW = 400
SAMPLE_CHARS = 2000

HIDDEN = 20
PATH_BUCKETS, WORD_BUCKETS = 40, 24

# Elements of running text, elements whose content is never text, and elements that
# an opening tag of the same group closes.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s "
    "samp small span strike strong sub sup time tt u var wbr audio canvas object video math maction merror "
    "mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub "
    "msubsup msup mtable mtd mtext mtr munder munderover semantics annotation".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
RAW = frozenset("script style iframe textarea title".split())
HIDDEN_TAGS = frozenset(("svg", "template"))

#: Sorts of places on a page, and the names of elements, classes and ids that point to them.
PLACES = {
    "content": "article main content post entry story maincontent",
    "nav": "nav navbar menu navigation breadcrumb breadcrumbs topbar pagination pager",
    "header": "header masthead branding logo",
    "footer": "footer foot copyright legal colophon",
    "side": "aside sidebar side related recommended widget trending popular share social sharing tags",
    "form": "form button select fieldset search login signup subscribe newsletter",
    "ad": "ad ads advert advertisement adsense banner promo promotion sponsor sponsored",
    "comment": "comment comments reply replies respond discussion disqus responses",
    "notice": "cookie cookies consent gdpr notice popup modal alert overlay notification dialog",
}
PLACE_NAMES = list(PLACES)
PLACE_OF = {word: number for number, words in enumerate(PLACES.values()) for word in words.split()}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|</?([a-zA-Z][^\s/>]*)(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|</?[a-zA-Z][^>]*>|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
CLOSING = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}
ANY_CLOSING = re.compile("</[a-zA-Z]")
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


#: Opening tags that are kept with what they mean, while a task reads pages.
KNOWN_TAGS = 8192


def _element(tag: str) -> tuple[str, tuple[int, ...], int]:
    """Name of an opening tag, the buckets of its name, classes and ids, and the place it points to
    (-1: none). Of several places one that is no content wins."""
    name = TAG.match(tag).group(1).lower()
    words = [name]
    for groups in NAMED.findall(tag):
        words += [p.lower() for p in PARTS.findall("".join(groups))]
    places = [PLACE_OF[w] for w in words if w in PLACE_OF]
    place = max(places, default=-1)
    return name, tuple(zlib.crc32(w.encode()) % PATH_BUCKETS for w in words), place


class Block:
    __slots__ = ("text", "path", "place", "outer", "tag", "linked")

    def __init__(self, text, path, place, outer, tag, linked):
        self.text, self.path, self.place, self.outer, self.tag, self.linked = text, path, place, outer, tag, linked


def _tokens(html: str):
    """Start, end, tag and name of all markup; without tag and name, comments and raw elements whole.
    Raw content ends with its closing tag; without one, before the next closing tag of any element."""
    at, unclosed = 0, set()
    while match := TOKEN.search(html, at):
        at, tag, name = match.end(), match.group(), (match.group(1) or "").lower()
        if name in RAW and tag[1] != "/":
            close = None if name in unclosed else CLOSING[name].search(html, at)
            if close is None:
                unclosed.add(name)
                close = ANY_CLOSING.search(html, at)
                at = close.start() if close else len(html)
            else:
                at = close.end()
            tag = name = ""
        elif tag[1] in "!?":
            tag = name = ""
        yield match.start(), at, tag, name


def _hidden(tokens: list[tuple]) -> dict[int, int]:
    """Drawings and templates that are closed, nested ones within the outermost: from the token that
    opens them to the one that closes them. What is never closed is a tag like any other."""
    out, open_ = {}, {name: [] for name in HIDDEN_TAGS}
    for number, (_, _, tag, name) in enumerate(tokens):
        if name not in HIDDEN_TAGS or tag.endswith("/>"):
            continue
        if tag[1] != "/":
            open_[name].append(number)
        elif open_[name]:
            out[open_[name].pop()] = number
    return out


def leaf_blocks(html: str, known: dict | None = None) -> list[Block]:
    """The texts between block-level tags, with the buckets of the enclosing elements, the innermost
    place they point to, whether one is content, the innermost block element, and the share of
    characters in links. References are decoded, white space is one space, and empty blocks are
    left out. Unclosed elements end with what encloses them; closing tags without an opening one
    and broken markup count for nothing. ``known`` keeps opening tags from one page to the next."""
    known = {} if known is None else known
    stack: list[tuple[str, tuple[int, ...], int]] = []
    out: list[Block] = []
    held: list[str] = []
    linked, total, at = 0, 0, 0

    def add(text):
        nonlocal linked, total
        if text:
            held.append(text)
            total += len(text)
            if any(e[0] == "a" for e in stack[-6:]):
                linked += len(text)

    def close():
        nonlocal held, linked, total
        if held:
            text = " ".join(unescape("".join(held)).split())
            if text:
                places = [e[2] for e in stack if e[2] >= 0]
                outer = 0 in places
                place = places[-1] if places else -1
                if place == PLACE_NAMES.index("header") and outer:  # the head of an article
                    place = 0
                tag = next((e[0] for e in reversed(stack) if e[0] not in INLINE), "")
                path = tuple(b for e in stack[-12:] for b in e[1])
                out.append(Block(text, path, place, outer, tag, linked / total))
            held, linked, total = [], 0, 0

    tokens = list(_tokens(html))
    hidden, number = _hidden(tokens), -1
    while (number := number + 1) < len(tokens):
        start, _, tag, name = tokens[number]
        add(html[at:start])
        number = hidden.get(number, number)
        at = tokens[number][1]
        if not name or name in HIDDEN_TAGS:
            continue
        if name not in INLINE:
            close()
        elif name == "br":
            add(" ")
        if tag[1] == "/":
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
                if name in INLINE and stack[depth][0] not in INLINE:
                    break
            continue
        if name in CLOSED_BY:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in CLOSED_BY[name]:
                    del stack[depth:]
                    break
                if stack[depth][0] not in INLINE and stack[depth][0] not in CLOSED_BY:
                    break
        if name not in VOID and not tag.endswith("/>"):
            if tag not in known:
                if len(known) >= KNOWN_TAGS:
                    known.clear()
                known[tag] = _element(tag)
            stack.append(known[tag])
    add(html[at:])
    close()
    return out


N_DENSE = len(PLACES) + 15
N_FEATURES = PATH_BUCKETS + WORD_BUCKETS + N_DENSE
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


def features(pages: list[list[Block]]) -> np.ndarray:
    """One vector per block, page after page."""
    blocks = [b for page in pages for b in page]
    out = np.zeros((len(blocks), N_FEATURES), dtype=np.float32)
    if not blocks:
        return out
    words = Words(pa.array([b.text for b in blocks]))
    hashes = words.hashes(lower=True)
    bucket = (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)
    sign = np.where(hashes >> np.uint64(63), 1.0, -1.0)
    row, n = words.row, np.maximum(words.counts, 1)
    bag = np.bincount(row * WORD_BUCKETS + bucket, sign, len(blocks) * WORD_BUCKETS)
    out[:, PATH_BUCKETS : PATH_BUCKETS + WORD_BUCKETS] = bag.reshape(len(blocks), -1) / np.sqrt(n)[:, None]
    base = PATH_BUCKETS + WORD_BUCKETS
    for i, b in enumerate(blocks):
        line = out[i]
        for p in b.path:
            line[p] = 1.0
        if b.place >= 0:
            line[base + b.place] = 1.0
        last = b.text[-1]
        line[base + len(PLACES) : base + len(PLACES) + 11] = (
            b.outer,
            b.tag == "p",
            b.tag in HEADINGS,
            b.tag == "li",
            b.tag in ("td", "th"),
            b.tag in ("div", "section", "body", ""),
            b.linked,
            last in ".!?…\"”",
            "©" in b.text,
            min(len(b.text), 2000) / 2000,
            sum(map(b.text.count, ",.;")) / len(b.text) * 10,
        )
    out[:, base + len(PLACES) + 11] = np.log1p(words.counts) / 6
    out[:, base + len(PLACES) + 12] = words.counts >= 12
    place = np.concatenate([np.arange(len(p)) for p in pages])
    size = np.concatenate([np.full(len(p), len(p)) for p in pages])
    out[:, base + len(PLACES) + 13] = place / size
    out[:, base + len(PLACES) + 14] = np.minimum(size, 100) / 100
    return out


def suggested(page: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """What the names around each block suggest, 1 content or 0, and how much that weighs. Without
    such names, text of some length outside links is taken for content, with little weight."""
    label = np.array([b.place == 0 if b.place >= 0 else len(b.text) >= 60 and b.linked < 0.3 for b in page], float)
    return label, np.array([1.0 if b.place >= 0 else 0.2 for b in page])


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Lstm:
    """One direction; gates in the order input, forget, output, candidate."""

    def __init__(self, rng, n_in):
        self.wx = rng.normal(0, 0.6 / np.sqrt(n_in), (n_in, 4 * HIDDEN))
        self.wh = rng.normal(0, 0.6 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        self.b = np.zeros(4 * HIDDEN)
        self.b[HIDDEN : 2 * HIDDEN] = 1.0

    def forward(self, x, mask):
        """``x``: time, page, feature; ``mask``: time, page. Padding leaves the state as it is."""
        steps, n = mask.shape
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        put = x @ self.wx + self.b
        states, trace = np.empty((steps, n, HIDDEN)), []
        for t in range(steps):
            z = put[t] + h @ self.wh
            gates, new = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            on = mask[t][:, None]
            cell = np.where(on, f * c + i * new, c)
            tanh = np.tanh(cell)
            out = np.where(on, o * tanh, h)
            trace.append((h, c, i, f, o, new, tanh))
            h, c = out, cell
            states[t] = h
        return states, trace

    def backward(self, x, mask, trace, d_states):
        steps, n = mask.shape
        d_put = np.zeros((steps, n, 4 * HIDDEN))
        d_wh = np.zeros_like(self.wh)
        dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        for t in range(steps - 1, -1, -1):
            h, c, i, f, o, new, tanh = trace[t]
            dh = dh + d_states[t]
            on = mask[t][:, None]
            d_out, d_cell = np.where(on, dh, 0), np.where(on, dc, 0)
            d_cell = d_cell + d_out * o * (1 - tanh**2)
            dz = np.concatenate(
                [
                    d_cell * new * i * (1 - i),
                    d_cell * c * f * (1 - f),
                    d_out * tanh * o * (1 - o),
                    d_cell * i * (1 - new**2),
                ],
                axis=1,
            )
            d_put[t] = dz
            d_wh += h.T @ dz
            dh = dz @ self.wh.T + np.where(on, 0, dh)
            dc = np.where(on, d_cell * f, dc)
        flat = x.reshape(-1, x.shape[2])
        return flat.T @ d_put.reshape(-1, 4 * HIDDEN), d_wh, d_put.sum((0, 1))


class Labeller:
    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.there, self.back = Lstm(rng, N_FEATURES), Lstm(rng, N_FEATURES)
        self.out = rng.normal(0, 0.3, 2 * HIDDEN + N_FEATURES) * np.r_[np.ones(2 * HIDDEN), np.zeros(N_FEATURES)]
        self.out0 = np.zeros(1)

    def weights(self):
        return [self.there.wx, self.there.wh, self.there.b, self.back.wx, self.back.wh, self.back.b, self.out, self.out0]

    def run(self, x, mask):
        """Padding comes last in time, so that the way back starts with it and keeps its zeros."""
        a, trace_a = self.there.forward(x, mask)
        b, trace_b = self.back.forward(x[::-1], mask[::-1])
        seen = np.concatenate([a, b[::-1], x], axis=2)
        return _sigmoid(seen @ self.out + self.out0), seen, trace_a, trace_b

    def gradients(self, x, mask, label, weight):
        p, seen, trace_a, trace_b = self.run(x, mask)
        d = (p - label) * weight * mask / max(weight.sum(), 1e-9)
        d_seen = d[:, :, None] * self.out
        there = self.there.backward(x, mask, trace_a, d_seen[:, :, :HIDDEN])
        back = self.back.backward(x[::-1], mask[::-1], trace_b, d_seen[::-1, :, HIDDEN : 2 * HIDDEN])
        return [*there, *back, (d[:, :, None] * seen).sum((0, 1)), d.sum(keepdims=True).ravel()[:1]]

    def label(self, pages: list[list[Block]], room: int = 1 << 14) -> list[np.ndarray]:
        """Probability of being content, for every block of every page. Pages of similar length are
        read together, and no more than ``room`` blocks with their padding."""
        sizes = np.array([len(p) for p in pages], dtype=np.int64)
        every, first = features(pages), np.cumsum(sizes) - sizes
        out = [np.zeros(0)] * len(pages)
        order = [i for i in np.argsort(sizes, kind="stable") if sizes[i]]
        begin = 0
        while begin < len(order):
            stop = begin + 1
            while stop < len(order) and sizes[order[stop]] * (stop - begin + 1) <= room:
                stop += 1
            chosen = order[begin:stop]
            x, mask = padded([every[first[i] : first[i] + sizes[i]] for i in chosen])
            p = self.run(x, mask)[0]
            for column, i in enumerate(chosen):
                out[i] = p[: sizes[i], column]
            begin = stop
        return out


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(r) for r in rows)
    x = np.zeros((steps, len(rows), N_FEATURES))
    mask = np.zeros((steps, len(rows)), dtype=bool)
    for i, r in enumerate(rows):
        x[: len(r), i], mask[: len(r), i] = r, True
    return x, mask


def varied(pages: list[list[Block]], rng) -> list[list[Block]]:
    """The pages again, with blocks of one page set into others under names that tell their place:
    so that every sort of place is learned whether the sample has it or not. The wording tells
    nothing then, only where it stands."""
    words = [(number, word) for number, names in enumerate(PLACES.values()) for word in names.split()]
    pool = [b for page in pages for b in page]
    out = []
    for page in pages:
        page = list(page)
        for _ in range(int(rng.integers(1, 5))):
            number, word = words[int(rng.integers(len(words)))]
            inner = bool(rng.integers(2)) and number > 0
            at = int(rng.integers(len(page) + 1))
            path = tuple(zlib.crc32(w.encode()) % PATH_BUCKETS for w in ("html", "body", *(["article"] * inner), "div", word))
            tag = ("p", "div", "li", "span", "h2")[int(rng.integers(5))]
            for b in rng.choice(len(pool), int(rng.integers(1, 5))):
                b = pool[b]
                linked = b.linked if number == 0 else float(rng.choice([b.linked, 0.0, 1.0]))
                page.insert(at, Block(b.text, path, number, inner or number == 0, tag, linked))
        out.append(page)
    return out


def train(
    pages: list[list[Block]], rounds: int = 12, batch: int = 24, rate: float = 0.01, least_steps: int = 150
) -> Labeller:
    """Adam on batches of pages and of their variations, in so many rounds, more if few pages make few
    steps. In a part of them what the names tell is
    blanked, so that the model also learns to go by text and surroundings."""
    rng = np.random.default_rng(11)
    model = Labeller()
    weights = model.weights()
    moment, energy, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    rounds = max(rounds, -(-least_steps // max(1, -(-2 * len(pages) // batch))))
    for _ in range(rounds):
        given = pages + varied(pages, rng)
        sizes = np.array([len(p) for p in given])
        every, first = features(given), np.cumsum(sizes) - sizes
        order = rng.permutation(len(given))
        order = order[np.argsort(sizes[order] // 8, kind="stable")]
        groups = [order[i : i + batch] for i in range(0, len(order), batch)]
        for g in rng.permutation(len(groups)):
            rows = []
            for i in groups[g]:
                r = every[first[i] : first[i] + sizes[i]].copy()
                if rng.random() < 0.2:
                    r[:, :PATH_BUCKETS] = 0
                    base = PATH_BUCKETS + WORD_BUCKETS
                    r[:, base : base + len(PLACES) + 1] = 0
                rows.append(r)
            x, mask = padded(rows)
            label, weight = np.zeros(mask.shape), np.zeros(mask.shape)
            for column, i in enumerate(groups[g]):
                label[: sizes[i], column], weight[: sizes[i], column] = suggested(given[i])
            step += 1
            for k, slope in enumerate(model.gradients(x, mask, label, weight)):
                slope = np.clip(slope, -1, 1)
                moment[k] = 0.9 * moment[k] + 0.1 * slope
                energy[k] = 0.999 * energy[k] + 0.001 * slope**2
                weights[k] -= rate * (moment[k] / (1 - 0.9**step)) / (np.sqrt(energy[k] / (1 - 0.999**step)) + 1e-8)
    return model


def _windows(page: list[Block], window: int, chars: int) -> list[list[tuple]]:
    """The blocks of a page, as plain values, in windows of about equal size that cover all of it."""
    n = -(-len(page) // window)
    edges = [len(page) * k // max(n, 1) for k in range(n + 1)]
    short = lambda t: t if len(t) <= chars else t[: chars - 1] + t[-1]
    return [[(short(b.text), b.path, b.place, b.outer, b.tag, b.linked) for b in page[lo:hi]]
            for lo, hi in zip(edges, edges[1:])]


def fit(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
    sample: int = SAMPLE, window: int = WINDOW, chars: int = SAMPLE_CHARS,
) -> Labeller | None:
    """Learn from at most ``sample`` windows of ``window`` blocks, drawn from at most as many pages of
    any length, the same ones in every run. Pages are read by the tasks; the driver gets the windows,
    with ``chars`` characters of a block. ``None`` if no page has a block."""
    html = F.col(html_col)
    keyed = pages.filter(html.isNotNull()).select(F.xxhash64(F.col(id_col), html).alias("key"), html.alias("html"))
    chosen = sampled(keyed.select("key"), sample, F.col("key")).distinct()  # at most ``sample`` numbers
    some = keyed.join(F.broadcast(chosen), "key").groupBy("key").agg(F.max("html").alias("html"))

    def read(batches):
        known = {}
        for batch in pieces(batches, "html"):
            for key, text in zip(batch.column("key").to_pylist(), batch.column("html").to_pylist()):
                found = [pickle.dumps(w) for w in _windows(leaf_blocks(text, known), window, chars)]
                yield pa.record_batch(
                    [pa.array([key] * len(found), pa.int64()), pa.array(range(len(found)), pa.int64()),
                     pa.array(found, pa.binary())], ["key", "number", "blocks"])

    found = some.mapInArrow(read, "key long, number long, blocks binary")
    rows = sampled(found, sample, F.col("key"), F.col("number")).collect()
    return train([[Block(*b) for b in pickle.loads(r["blocks"])] for r in rows]) if rows else None


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: Labeller | None = None
) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars``.

    ``text`` joins by a line feed, in page order, the blocks that the model takes for content; a line
    break within a block is white space. Null and empty pages, and pages without content, have an
    empty text. Repeated rows are extracted alike; an empty table gives an empty result. Without
    anything to learn from, what the names around a block suggest decides.
    """
    model = model or fit(pages, id_col, html_col)
    label = model.label if model else lambda read: [suggested(page)[0] for page in read]
    chosen = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def extract(batches):
        known = {}
        for batch in pieces(batches, "html", 2 << 20):
            read = [leaf_blocks(h or "", known) for h in batch.column("html").to_pylist()]
            texts = [
                "\n".join(b.text for b, x in zip(page, p) if x >= 0.5)
                for page, p in zip(read, label(read))
            ]
            n = pa.array([len(t) for t in texts], pa.int64())
            yield pa.record_batch(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), n],
                ["page_id", "url", "text", "n_chars"],
            )

    blank = [F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")]
    return chosen.mapInArrow(extract, chosen.select("page_id", "url", *blank).schema)
