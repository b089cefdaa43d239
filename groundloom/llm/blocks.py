"""Main text of HTML pages: a bidirectional LSTM labels every leaf block of a page as article or not.

A page is read into its sequence of blocks. Each block is a vector of its hashed tag path (tags, classes, ids), hashed
words and a few measures; the network reads the whole sequence in both directions, so every block is judged in the context
of the page. It is trained on pages whose markup names the article, partly with the names replaced or taken away and with
named boilerplate put in, so that it neither depends on one name nor mistakes, say, comments for the article.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundloom.llm.common import in_small_batches, table
from groundloom.llm.words import Words

PATH_TOKENS = 64            # the innermost tag and class names of a block's path
PATH_BUCKETS, WORD_BUCKETS, MEASURES = 1024, 64, 6
INPUTS = PATH_BUCKETS + WORD_BUCKETS + MEASURES
HIDDEN = 16
TRAIN_PAGES = 300
TRAIN_BLOCKS = 60          # blocks of a training window; longer pages are cut into windows
VARIANTS = 4               # of each training page, besides itself
EPOCHS, BATCH, RATE = 8, 32, 0.01
CELLS = 20_000             # blocks, with padding, that go through the network at a time
READ_CHARS = 1_000_000     # characters of pages, about, that are read at a time

# How HTML divides a page, and the names by which markup tells an article from what surrounds it.
BLOCK_TAGS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
 figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav ol optgroup option p pre
 search section select summary table tbody td template textarea tfoot th thead title tr ul""".split())
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN_TAGS = set("script style noscript template svg head title iframe object canvas math audio video".split())
# Tags that end where the key begins, as their end tags may be left out.
CLOSED_BY = {"li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "dt": ("dt", "dd"), "dd": ("dt", "dd"),
             "option": ("option",), "optgroup": ("option", "optgroup"), "thead": ("caption",),
             "tbody": ("td", "th", "tr", "thead", "tbody", "caption"), "tfoot": ("td", "th", "tr", "thead", "tbody", "caption")}
MAIN_NAMES = "article main content post entry story".split()
OTHER_NAMES = """nav menu header footer aside sidebar ad ads advert advertisement sponsor promo banner cookie consent notice
 alert popup modal comments comment reply respond related recommended share social newsletter subscribe form login search
 breadcrumb breadcrumbs pagination pager widget toolbar tags meta byline copyright legal""".split()
_sign = np.isin(np.arange(256), [ord(c) for c in ".,;!?"])
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")


class PageReader(HTMLParser):
    """Collects (text, path tokens, characters inside links) of each leaf block in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, tuple[str, ...], int]] = []
        self.path: list[tuple[str, tuple[str, ...]]] = []      # tag and the tokens of the path down to it
        self.text: list[str] = []
        self.linked = self.links = 0
        self.unseen: list[str] = []

    def end_block(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.blocks.append((text, self.path[-1][1] if self.path else (), min(self.linked, len(text))))
        self.text, self.linked, self.links = [], 0, 0

    def handle_starttag(self, tag, attrs):
        if tag in UNSEEN_TAGS and tag not in VOID_TAGS:
            self.unseen.append(tag)
        if tag == "body":
            self.unseen.clear()                       # a head that was not closed
        if tag == "br":
            self.text.append(" ")
        elif tag == "a":
            self.links = 1
        if tag not in BLOCK_TAGS:
            return
        self.end_block()
        if tag in VOID_TAGS:
            return
        if self.path and self.path[-1][0] == "p":     # a paragraph ends where the next block begins
            self.path.pop()
        while self.path and self.path[-1][0] in CLOSED_BY.get(tag, ()):
            self.path.pop()
        names = [tag]
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names += _NAME.findall(value.lower())
        above = self.path[-1][1] if self.path else ()
        self.path.append((tag, (*above, *names)[-PATH_TOKENS:]))

    def handle_endtag(self, tag):
        if tag in self.unseen:
            while self.unseen and self.unseen.pop() != tag:
                pass
        if tag == "a":
            self.links = 0
        if tag not in BLOCK_TAGS:
            return
        self.end_block()
        for i in range(len(self.path) - 1, -1, -1):
            if self.path[i][0] == tag:
                del self.path[i:]
                break

    def handle_data(self, data):
        if not self.unseen:
            self.text.append(data)
            if self.links:
                self.linked += len(data)


def read_blocks(html: str) -> list[tuple[str, tuple[str, ...], int]]:
    """Blocks of a page; character references are decoded and white space is one space."""
    reader = PageReader()
    reader.feed(html)
    reader.close()
    reader.end_block()
    return reader.blocks


def weak_label(path: tuple[str, ...]) -> int | None:
    """1 in a named article, 0 in named boilerplate or outside the article, None if the page names nothing here."""
    if any(t in OTHER_NAMES for t in path):
        return 0
    return 1 if any(t in ("article", "main") for t in path) else None


class Inputs:
    """Vectors of consecutive blocks: the distinct tag paths as rows of ``paths``, each block's row ``path`` of it, and
    the shares of its hashed words and its measures in ``rest``."""

    def __init__(self, pages: list[list[tuple[str, tuple[str, ...], int]]]):
        blocks = [b for p in pages for b in p]
        self.first = np.append(0, np.cumsum([len(p) for p in pages])).astype(np.int64)
        known: dict[tuple[str, ...], int] = {}
        self.path = np.fromiter((known.setdefault(b[1], len(known)) for b in blocks), np.int64, len(blocks))
        self.paths = np.zeros((len(known), PATH_BUCKETS), np.float32)
        for tokens, i in known.items():
            for token in tokens:
                self.paths[i, zlib.crc32(token.encode("utf-8", "surrogatepass")) % PATH_BUCKETS] = 1
        raw = [b[0].encode("utf-8", "surrogatepass") for b in blocks]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum(sizes))
        words = Words(data, offsets)
        number = np.maximum(np.diff(words.first), 1)
        bucket = (words.hash >> np.uint64(40)).astype(np.int64) % WORD_BUCKETS
        share = np.bincount(words.row * WORD_BUCKETS + bucket, minlength=len(raw) * WORD_BUCKETS).reshape(-1, WORD_BUCKETS)
        signs = np.bincount(np.repeat(np.arange(len(raw)), sizes), weights=_sign[data], minlength=len(raw))
        page = np.repeat(np.arange(len(pages)), np.diff(self.first))
        count = np.diff(self.first)[page]
        linked = np.fromiter((b[2] / len(b[0]) for b in blocks), float, len(blocks))
        measures = [np.log1p(sizes) / 5, np.log1p(number) / 5, linked, (np.arange(len(raw)) - self.first[page]) / np.maximum(count - 1, 1),
                    np.minimum(signs / number, 2), np.log1p(count) / 5]
        self.rest = np.hstack([share / number[:, None], np.stack(measures, axis=1)]).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM with a linear output; parameters are float32 arrays by name."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.p: dict[str, np.ndarray] = {}
        for side in ("f", "b"):
            self.p["W" + side] = rng.normal(0, 0.1, (INPUTS, 4 * HIDDEN))
            self.p["U" + side] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN:2 * HIDDEN] = 1.0              # remember at first
            self.p["c" + side] = bias
        self.p["V"] = rng.normal(0, 0.1, (2 * HIDDEN, 1))
        self.p["S"] = np.zeros((INPUTS, 1))
        self.p["d"] = np.zeros(1)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _run(self, side: str, pre: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        rows, steps = mask.shape
        h = np.zeros((rows, HIDDEN), np.float32)
        c = np.zeros((rows, HIDDEN), np.float32)
        out = np.zeros((rows, steps, HIDDEN), np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = pre[:, t] + h @ self.p["U" + side]
            i, f, o = (sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[:, t:t + 1]
            before_h, before_c = h, c
            c = m * (f * c + i * g) + (1 - m) * c
            s = np.tanh(c)
            h = m * o * s + (1 - m) * h
            out[:, t] = h
            if keep is not None:
                keep.append((t, i, f, o, g, s, m, before_h, before_c))
        return out

    def scores(self, found: Inputs) -> np.ndarray:
        """Probability of article for each block of the pages. Pages of similar length go through together."""
        weights = np.hstack([self.p["Wf"], self.p["Wb"], self.p["S"]])
        pre = (found.paths @ weights[:PATH_BUCKETS])[found.path] + found.rest @ weights[PATH_BUCKETS:]
        size = np.diff(found.first)
        order = [i for i in np.argsort(size, kind="stable") if size[i]]
        out = np.zeros(len(pre), np.float32)
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and size[order[end]] * (end + 1 - at) <= CELLS:
                end += 1
            x, mask = padded([pre[found.first[i]:found.first[i + 1]] for i in order[at:end]])
            both = [self._run(s, x[:, :, n * 4 * HIDDEN:(n + 1) * 4 * HIDDEN] + self.p["c" + s], mask, None) for n, s in enumerate("fb")]
            score = sigmoid((np.concatenate(both, axis=2) @ self.p["V"])[:, :, 0] + x[:, :, -1] + self.p["d"][0])
            for row, i in enumerate(order[at:end]):
                out[found.first[i]:found.first[i + 1]] = score[row, :size[i]]
            at = end
        return out

    def gradients(self, found: Inputs, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy over the blocks, by their weight."""
        weights = np.hstack([self.p["Wf"], self.p["Wb"], self.p["S"]])
        pre = (found.paths @ weights[:PATH_BUCKETS])[found.path] + found.rest @ weights[PATH_BUCKETS:]
        x, mask = padded([pre[a:b] for a, b in zip(found.first, found.first[1:])])
        real = mask > 0                                # in row order, so that real cells are the blocks in order
        kept: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self._run(s, x[:, :, n * 4 * HIDDEN:(n + 1) * 4 * HIDDEN] + self.p["c" + s], mask, kept[s])
                               for n, s in enumerate("fb")], axis=2)
        score = sigmoid((both[real] @ self.p["V"])[:, 0] + pre[:, -1] + self.p["d"][0])
        flat = ((score - label) * weight / max(weight.sum(), 1))[:, None].astype(np.float32)
        error = np.zeros((*mask.shape, 1), np.float32)
        error[real] = flat
        out = {"V": both[real].T @ flat, "d": flat.sum(axis=0)}
        back, moved = error @ self.p["V"].T, []
        for n, side in enumerate("fb"):
            dh_out = back[:, :, n * HIDDEN:(n + 1) * HIDDEN]
            dz_all = np.zeros((*mask.shape, 4 * HIDDEN), np.float32)
            du = np.zeros_like(self.p["U" + side])
            dh = np.zeros((len(mask), HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, i, f, o, g, s, m, before_h, before_c in reversed(kept[side]):
                dh = dh + dh_out[:, t]
                inner = m * dh
                step = m * dc + inner * o * (1 - s * s)
                dz = np.concatenate([step * g * i * (1 - i), step * before_c * f * (1 - f), inner * s * o * (1 - o),
                                     step * i * (1 - g * g)], axis=1)
                dz_all[:, t] = dz
                du += before_h.T @ dz
                dc = step * f + (1 - m) * dc
                dh = dz @ self.p["U" + side].T + (1 - m) * dh
            out["U" + side] = du
            moved.append(dz_all[real])
            out["c" + side] = moved[-1].sum(axis=0)
        every = np.hstack([*moved, flat])
        of_path = (np.arange(len(found.paths))[:, None] == found.path[None, :]).astype(np.float32)
        into = np.vstack([found.paths.T @ (of_path @ every), found.rest.T @ every])
        out["Wf"], out["Wb"], out["S"] = into[:, :4 * HIDDEN], into[:, 4 * HIDDEN:8 * HIDDEN], into[:, 8 * HIDDEN:]
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((len(pages), steps, pages[0].shape[1]), np.float32)
    mask = np.zeros((len(pages), steps), np.float32)
    for i, page in enumerate(pages):
        x[i, :len(page)] = page
        mask[i, :len(page)] = 1
    return x, mask


def varied(blocks: list, labels: list, rng: np.random.Generator, spare: list) -> tuple[list, list]:
    """A training page with the article's name replaced or dropped, boilerplate renamed, unknown names strewn in, and
    named boilerplate that holds article text put in anywhere."""
    main = rng.choice(MAIN_NAMES, int(rng.integers(0, 4)), replace=False).tolist()
    other = {t: str(rng.choice(OTHER_NAMES)) for t in OTHER_NAMES}
    noise = f"x{rng.integers(1000)}" if rng.random() < 0.5 else None
    out, marks = [], []

    def path_of(path) -> tuple[str, ...]:
        names = []
        for t in path:
            if t in ("article", "main"):
                names += ["div", *main]
            elif t in other:
                names += ["div", other[t]]
            else:
                names.append(t)
        return (*names, noise) if noise else tuple(names)

    put = set(rng.integers(0, len(blocks) + 1, int(rng.integers(1, 4))).tolist()) if spare else set()
    for k, ((text, path, linked), mark) in enumerate([*zip(blocks, labels), (("", blocks[-1][1], 0), 0)] if blocks else []):
        if k in put or (k in (0, len(blocks) - 1) and spare and rng.random() < 0.3):
            holder = path_of(path[:max(len(path) - 1, 0)])
            name = str(rng.choice(OTHER_NAMES))
            for _ in range(int(rng.integers(1, 4))):
                held = spare[rng.integers(len(spare))]
                if rng.random() < 0.5:
                    held = " ".join(held.split(" ")[:int(rng.integers(1, 12))])
                out.append((held, (*holder, *(["div"] if rng.random() < 0.5 else []), name, "p"), 0))
                marks.append(0)
        if k < len(blocks):
            out.append((text, path_of(path), linked))
            marks.append(mark)
    return out, marks


def train(pages: list[list], seed: int = 5) -> Labeller:
    """A labeller fitted to parsed pages; blocks without a weak label carry no weight. Without any it labels by chance
    of its start, so callers need pages that name their article."""
    rng = np.random.default_rng(seed)
    data = []
    spare = [b[0] for p in pages for b in p if weak_label(b[1]) == 1]
    for blocks in pages:
        marks = [weak_label(path) for _, path, _ in blocks]
        if 1 in marks:                                # the page names its article: what is outside is none
            marks = [m or 0 for m in marks]
        for turn in range(1 + VARIANTS):
            b, m = (blocks, marks) if turn == 0 else varied(blocks, marks, rng, spare)
            if b:
                data.append((b, m))
    data.sort(key=lambda d: len(d[0]) + rng.integers(8))
    batches = []
    for i in range(0, len(data), BATCH):
        marks = [x for _, m in data[i:i + BATCH] for x in m]
        batches.append((Inputs([b for b, _ in data[i:i + BATCH]]), np.array([x or 0 for x in marks], np.float32),
                        np.array([x is not None for x in marks], np.float32)))
    model = Labeller(seed)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    step = 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(batches)):
            step += 1
            for name, g in model.gradients(*batches[k]).items():
                g = np.clip(g, -1, 1)
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.999 * second[name] + 0.001 * g * g
                model.p[name] = model.p[name] - RATE * (first[name] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-8)
    return model


def main_texts(model: Labeller, htmls: list[str]) -> list[str]:
    """Main text of each page: the blocks labelled article, in page order, one to a line."""
    out, at = [], 0
    while at < len(htmls):
        size, end = 0, at
        while end < len(htmls) and (end == at or size + len(htmls[end]) <= READ_CHARS):
            size += len(htmls[end])
            end += 1
        pages = [read_blocks(h) for h in htmls[at:end]]
        found = Inputs(pages)
        main = model.scores(found) >= 0.5
        out += ["\n".join(b[0] for b, m in zip(page, main[a:]) if m) for page, a in zip(pages, found.first)]
        at = end
    return out


def window_of(blocks: list, seed: int) -> list:
    """``TRAIN_BLOCKS`` consecutive blocks of a page, or all if it has fewer. A window of a longer page holds the begin or the end
    of a named article where there is one, so training sees both sides of its borders."""
    if len(blocks) <= TRAIN_BLOCKS:
        return blocks
    rng = np.random.default_rng(seed & 0x7FFFFFFF)
    marks = np.array([weak_label(path) == 1 for _, path, _ in blocks])
    borders = np.flatnonzero(marks[1:] != marks[:-1]) + 1
    middle = int(rng.choice(borders)) if len(borders) else int(rng.integers(len(blocks)))
    begin = min(max(middle - int(rng.integers(TRAIN_BLOCKS // 4, 3 * TRAIN_BLOCKS // 4)), 0), len(blocks) - TRAIN_BLOCKS)
    return blocks[begin:begin + TRAIN_BLOCKS]


def fitted(pages: DataFrame, id_col: str, html_col: str, count: int = TRAIN_PAGES) -> Labeller:
    """A labeller trained by the driver on a window of each of ``count`` pages, chosen by the hash of their id; no more reaches it.

    Pages of any length take part. If pages were read but none of them names its article, there is nothing to learn
    from, which is an error.
    """
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = batch.column(0).to_pylist()
            found = [window_of(read_blocks(h or ""), seed) for seed, h in zip(seeds, batch.column(1).to_pylist())]
            keep = [i for i, f in enumerate(found) if f]
            rows = [[{"text": t, "path": list(p), "linked": n} for t, p, n in found[i]] for i in keep]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(rows, pa.list_(pa.struct(
                    [("text", pa.string()), ("path", pa.list_(pa.string())), ("linked", pa.int32())])))], ["id", "blocks"])

    key = F.xxhash64(F.col(id_col))
    chosen = pages.select(key.alias("h")).distinct().orderBy("h").limit(2 * count)         # at most 2 * count numbers
    rows = pages.select(key.alias("h"), F.col(html_col).cast("string").alias("html")).join(F.broadcast(chosen), "h")
    found = in_small_batches(rows).mapInArrow(blocks, "id bigint, blocks array<struct<text:string,path:array<string>,linked:int>>")
    found = found.orderBy("id").limit(count).collect()
    windows = [[(b["text"], tuple(b["path"]), b["linked"]) for b in r["blocks"]] for r in found]
    if windows and not any(weak_label(path) == 1 for w in windows for _, path, _ in w):
        raise ValueError("no page names its article by an <article> or <main> element")
    return train(windows)


def extract(pages: DataFrame, model: Labeller, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``, the main text. A null or blockless page has an empty text; other columns stay as they are.

    Pages go through the network in groups of similar length, so that memory stays within ``CELLS`` blocks or one page.
    """
    shared = in_small_batches(pages).sparkSession.sparkContext.broadcast(model)

    def run(column: pa.Array) -> pa.Array:
        return pa.array(main_texts(shared.value, [h or "" for h in column.to_pylist()]), pa.string())

    return pages.withColumn(out, F.arrow_udf(run, "string")(F.col(html_col).cast("string")))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each row of ``pages``."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract(pages, fitted(pages, "page_id", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
