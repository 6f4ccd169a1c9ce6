"""Operator 4 - main text of HTML pages by a recurrent block labeller.

A page becomes a sequence of leaf blocks (runs of text between block-level tags).  A block is a hashed vector of its
tag path (tags with their class and id words), a hashed vector of all its words (their mean) and a few numbers; a bidirectional LSTM in
numpy reads the page's whole sequence and labels each block as article text or not.  It is trained at the start of a
job on pages that a seeded generator makes up with many layouts, so no labelled page is needed and the model is the
same in every run.

Scripts, styles, comments and markup never become blocks.  Character references are decoded, white space in a block
becomes one blank, blocks are trimmed and joined by one newline in page order.  Null and empty pages and pages
without article blocks give an empty text; repeated pages are extracted each; extra columns are ignored; broken
markup (unclosed tags or quotes) is read as far as it goes; blocks have no ties.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PATH, WORDS, NUMBERS, HIDDEN = 64, 24, 8, 16
TRAIN_PAGES, EPOCHS = 1200, 6
PAGES_AT_ONCE = 256
DEPTH = 40  # of a tag path: deeper nesting is broken markup

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|svg|textarea|select)\b[^<>]*+(?:<(?![a-zA-Z/!?])[^<>]*+)*+>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)(?:>|(?=<)|\Z)",
    re.S | re.I,
)
_MARKS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ENDS_P = _BLOCK - frozenset("button caption label option td th tr tbody thead tfoot".split())


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """(tag path of the DEPTH nearest block tags from the outside in, text, characters inside links) of every leaf block."""
    stack: list[tuple[str, str]] = []  # (tag, tag with its class and id words)
    opened: Counter[str] = Counter()  # of the stack
    frame: list[str] = []  # the block tags of the stack
    out: list[tuple[tuple[str, ...], str, int]] = []
    parts: list[str] = []
    links, path = 0, ()

    def flush() -> None:
        nonlocal links
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append((path, text, links))
        parts.clear()
        links = 0

    def take(text: str) -> None:
        nonlocal links, path
        if text:
            if not parts or not path:
                path = tuple(frame[-DEPTH:])
            parts.append(text)
            if opened["a"]:
                links += len(text)

    def close(first: int) -> None:
        for name, _ in stack[first:]:
            opened[name] -= 1
            if name in _BLOCK:
                frame.pop()
        del stack[first:]

    at = 0
    for m in _TOKEN.finditer(page):
        take(page[at : m.start()])
        at = m.end()
        tag = m[3] or m[6]
        if not tag:
            continue
        tag, closing = tag.lower(), m[2] or m[5]
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _BLOCK:
            flush()
        if closing:
            for i in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[i][0] == tag:
                    close(i)
                    break
        elif tag not in _VOID:
            if tag in _ENDS_P and opened["p"]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        close(i)
                        break
                    if stack[i][0] in _BLOCK:
                        break
            attrs = m[4] or m[7]
            marks = " ".join(a or b or c for a, b, c in _MARKS.findall(attrs)).lower() if attrs else ""
            stack.append((tag, f"{tag} {marks}" if marks else tag))
            opened[tag] += 1
            if tag in _BLOCK:
                frame.append(stack[-1][1])
    take(page[at:])
    flush()
    return out


_vectors: dict[tuple[str, ...], np.ndarray] = {}
_hashes: dict[str, int] = {}


def _hash(token: str) -> int:
    if (h := _hashes.get(token)) is None:
        if len(_hashes) > 200_000:
            _hashes.clear()
        h = _hashes[token] = zlib.crc32(token.encode("utf-8", "replace"))
    return h


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    if (v := _vectors.get(path)) is None:
        if len(_vectors) > 50_000:
            _vectors.clear()
        v = np.zeros(PATH, np.float32)
        for depth, node in enumerate(reversed(path)):
            tag, *marks = re.findall(r"[a-z0-9]+", node)
            for token, amount in [(tag if depth else f"{tag}.", 1.0), *((f"{'in ' * (depth > 0)}{x}", 1.0) for x in marks)]:
                h = _hash(token)
                v[h % PATH] += amount * (1 if h >> 16 & 1 else -1)
                v[(h >> 8) % PATH] += amount * (1 if h >> 17 & 1 else -1)
        _vectors[path] = v
    return v


def vectors(page: list[tuple[tuple[str, ...], str, int]]) -> np.ndarray:
    out = np.zeros((len(page), PATH + WORDS + NUMBERS), np.float32)
    for i, (path, text, links) in enumerate(page):
        row = out[i]
        row[:PATH] = _path_vector(path)
        some = text.lower().split()
        for w in some:
            h = _hash(w.strip(".,:;!?()[]\"'"))
            row[PATH + h % WORDS] += (1 if h >> 16 & 1 else -1) / len(some)
        spaces = text.count(" ") + 1
        row[PATH + WORDS :] = (np.log1p(len(text)) / 5, min(links / len(text), 1), np.log1p(spaces) / 4, text[-1] in ".!?", text.count(",") / spaces, len(text) / spaces / 10, i / len(page), "©" in text)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _reverse(n: np.ndarray, length: int) -> np.ndarray:
    """For each page, positions with its own blocks in reverse order."""
    i = np.arange(length)
    return np.where(i < n[:, None], n[:, None] - 1 - i, i)


def _run(w: dict, side: str, x: np.ndarray, keep: bool = True) -> dict:
    """One direction of the LSTM over (pages, blocks, inputs); keeps what the gradient needs, if asked to."""
    n, length, _ = x.shape
    z_in = x @ w[side + "x"] + w[side + "b"]
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    hs = np.zeros((n, length, HIDDEN), np.float32)
    cs, gates = (np.zeros((n, length if keep else 1, size), np.float32) for size in (HIDDEN, 4 * HIDDEN))
    for s in range(length):
        z = z_in[:, s] + h @ w[side + "h"]
        g = gates[:, s if keep else 0]
        g[:, : 3 * HIDDEN] = _sigmoid(z[:, : 3 * HIDDEN])
        g[:, 3 * HIDDEN :] = np.tanh(z[:, 3 * HIDDEN :])
        c = g[:, HIDDEN : 2 * HIDDEN] * c + g[:, :HIDDEN] * g[:, 3 * HIDDEN :]
        h = g[:, 2 * HIDDEN : 3 * HIDDEN] * np.tanh(c)
        hs[:, s], cs[:, s if keep else 0] = h, c
    return {"x": x, "h": hs, "c": cs, "g": gates}


def _back(w: dict, side: str, kept: dict, dh_out: np.ndarray, grad: dict) -> None:
    x, hs, cs, gates = kept["x"], kept["h"], kept["c"], kept["g"]
    n, length, _ = x.shape
    dz_all = np.zeros_like(gates)
    dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    H = HIDDEN
    for s in range(length - 1, -1, -1):
        g, tc = gates[:, s], np.tanh(cs[:, s])
        before = cs[:, s - 1] if s else np.zeros_like(dc)
        dh = dh + dh_out[:, s]
        dc = dc + dh * g[:, 2 * H : 3 * H] * (1 - tc * tc)
        dz = dz_all[:, s]
        dz[:, :H] = dc * g[:, 3 * H :] * g[:, :H] * (1 - g[:, :H])
        dz[:, H : 2 * H] = dc * before * g[:, H : 2 * H] * (1 - g[:, H : 2 * H])
        dz[:, 2 * H : 3 * H] = dh * tc * g[:, 2 * H : 3 * H] * (1 - g[:, 2 * H : 3 * H])
        dz[:, 3 * H :] = dc * g[:, :H] * (1 - g[:, 3 * H :] ** 2)
        dh, dc = dz @ w[side + "h"].T, dc * g[:, H : 2 * H]
    flat = dz_all.reshape(-1, 4 * H)
    grad[side + "x"] = x.reshape(-1, x.shape[2]).T @ flat
    grad[side + "b"] = flat.sum(0)
    grad[side + "h"] = hs[:, :-1].reshape(-1, H).T @ dz_all[:, 1:].reshape(-1, 4 * H)


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(p) for p in pages])
    x = np.zeros((len(pages), max(n.max(), 1), PATH + WORDS + NUMBERS), np.float32)
    for i, p in enumerate(pages):
        x[i, : len(p)] = p
    return x, n


def forward(w: dict, x: np.ndarray, n: np.ndarray, keep: bool = True) -> tuple[np.ndarray, dict, dict, np.ndarray]:
    turn = _reverse(n, x.shape[1])
    ahead, back = _run(w, "f", x, keep), _run(w, "r", np.take_along_axis(x, turn[:, :, None], 1), keep)
    both = np.concatenate([ahead["h"], np.take_along_axis(back["h"], turn[:, :, None], 1)], 2)
    return both @ w["o"] + w["ob"], ahead, back, turn


@cache
def train(seed: int = 4) -> dict:
    """LSTM weights, fitted by Adam to the generator's pages; once in a process for each seed."""
    rng = np.random.default_rng(seed)
    pages = [_made_up(rng) for _ in range(TRAIN_PAGES)]
    cut = [blocks(page) for page, _ in pages]
    xs = [vectors(b) for b in cut]
    ys = [np.array([text in good for _, text, _ in b], np.float32) for b, (_, good) in zip(cut, pages, strict=True)]
    size = PATH + WORDS + NUMBERS
    w = {s + k: rng.normal(0, d, shape).astype(np.float32) for s in "fr" for k, d, shape in (("x", 0.1, (size, 4 * HIDDEN)), ("h", 0.15, (HIDDEN, 4 * HIDDEN)), ("b", 0.01, (4 * HIDDEN,)))}
    w |= {"o": rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32), "ob": np.zeros((), np.float32)}
    m, v, step = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(xs))
        for batch in np.array_split(order[np.argsort([len(xs[i]) for i in order], kind="stable")], len(xs) // 24):
            x, n = _padded([xs[i] for i in batch])
            y = np.zeros(x.shape[:2], np.float32)
            for row, i in enumerate(batch):
                y[row, : n[row]] = ys[i]
            z, ahead, back, turn = forward(w, x, n)
            live = np.arange(x.shape[1]) < n[:, None]
            dz = ((_sigmoid(z) - y) * live / live.sum()).astype(np.float32)
            both = np.concatenate([ahead["h"], np.take_along_axis(back["h"], turn[:, :, None], 1)], 2)
            grad = {"o": np.einsum("ps,psh->h", dz, both), "ob": dz.sum()}
            dh = dz[:, :, None] * w["o"]
            _back(w, "f", ahead, dh[:, :, :HIDDEN], grad)
            _back(w, "r", back, np.take_along_axis(dh[:, :, HIDDEN:], turn[:, :, None], 1), grad)
            step += 1
            for k, g in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                w[k] = (w[k] - 0.01 * 0.7**epoch * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return w


def _made_up(rng: np.random.Generator) -> tuple[str, set[str]]:
    """A page of a random layout and the texts of its article blocks."""
    pick = lambda *x: x[rng.integers(len(x))]
    syllables = "the an re on er ti es la de un st ou ch ge sch ra mo lo vi pa cu el do qu ñ é ü ö ä è ß".split()
    word = lambda: "".join(pick(*syllables) for _ in range(rng.integers(1, 5)))
    serial = iter(range(10**9))
    good: set[str] = set()

    def words(low: int, high: int, *cues: str) -> str:
        out = [word() for _ in range(rng.integers(low, high))]
        if cues and rng.random() < 0.6:
            out.insert(int(rng.integers(0, 2)), pick(*cues))
        return " ".join(out) + f" {word()}{next(serial)}"

    def said(text: str) -> str:
        good.add(text)
        return text

    def prose() -> str:
        n = int(rng.integers(1, 9) if rng.random() < 0.8 else rng.integers(9, 40))
        return " ".join(words(1, 14).capitalize() + pick(".", ".", ".", "!", ",", "&&", "***") for _ in range(n))

    def lines(row: str, n: int, *cues: str) -> str:
        return "".join(row.format(words(1, 4, *cues)) for _ in range(n))

    def ad() -> str:
        return pick('<div class="ad">{}</div>', '<div class="advert banner"><p>{}</p></div>', '<aside class="sponsored">{}</aside>', '<div id="ads"><a href="#">{}</a></div>', '<div class="promo ads">{}</div>').format(words(2, 16, "sponsored", "advertisement", "buy", "offer"))

    def nav() -> str:
        row = pick('<li><a href="/x">{}</a></li>', '<li class="menu-item"><a href="/y">{}</a></li>')
        return pick("<nav><ul>{}</ul></nav>", '<div class="menu"><ul>{}</ul></div>', '<ul id="navigation" class="nav">{}</ul>', '<div role="navigation" class="navbar breadcrumbs"><ul>{}</ul></div>').format(lines(row, int(rng.integers(1, 9)), "home", "menu", "login"))

    def header() -> str:
        return pick("<header><div>{}</div></header>", '<div id="header" class="masthead"><p>{}</p></div>', '<header class="site-header"><h1>{}</h1></header>', '<div class="topbar"><span>{}</span></div>').format(words(1, 9, "welcome", "search"))

    def notice() -> str:
        return pick('<div class="cookie-notice"><p>{}</p></div>', '<div class="alert notice">{}</div>', '<div id="consent" class="popup modal"><p>{}</p><button>ok</button></div>').format(words(3, 25, "cookies", "privacy", "accept", "javascript"))

    def form() -> str:
        return pick('<form><label>{}</label><input name="q"><button>{}</button></form>', '<form class="newsletter subscribe"><p>{}</p><button>{}</button></form>', '<div class="signup"><form><label>{}</label><p>{}</p></form></div>').format(words(1, 9, "subscribe", "email", "search"), words(1, 2, "send"))

    def side() -> str:
        row = pick('<li><a href="/z">{}</a></li>', "<p>{}</p>", "<h3>{}</h3>")
        return pick("<aside>{}</aside>", '<div class="sidebar widget">{}</div>', '<div id="sidebar"><ul>{}</ul></div>', '<section class="related recommended"><ul>{}</ul></section>').format(lines(row, int(rng.integers(1, 7)), "related", "popular", "recent"))

    def comments() -> str:
        row = pick('<li class="comment"><p>{}</p></li>', '<div class="comment-body"><b>{}</b></div>', "<p>{}</p>", '<div class="reply"><p>{}</p></div>')
        body = "".join(row.format(prose() + f" {next(serial)}") for _ in range(rng.integers(1, 6)))
        return pick('<section class="comments"><h2>comments</h2>{}</section>', '<div id="comments"><ol>{}</ol></div>', '<div class="comment-list responses">{}</div>', '<section id="discussion" class="comments">{}</section>').format(body)

    def footer() -> str:
        sign = pick("&copy; {} &middot; ", "{} ", "Copyright {} ").format(words(1, 3))
        return pick("<footer>{}</footer>", '<div id="footer"><p>{}</p></div>', '<footer class="site-footer"><ul><li>{}</li></ul></footer>', '<div class="copyright footer">{}</div>').format(sign + (prose() if rng.random() < 0.4 else words(1, 14)))

    def article() -> str:
        body = [pick("<h1>{}</h1>", "<h1>{}</h1>", "<h2>{}</h2>", "<header><h1>{}</h1></header>").format(said(words(1, 12) + pick("", ".")))]
        for _ in range(int(rng.integers(0, 9) if rng.random() < 0.9 else rng.integers(9, 40))):
            text = said(prose() + f" {next(serial)}") if rng.random() < 0.85 else said(words(1, 4) + ".")
            body.append(pick("<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<p><b>{}<br>", "<p>{}", '<p class="text">{}</p>', "<blockquote>{}</blockquote>", "<div>{}</div>", "<ul><li>{}</li></ul>", "<h2>{}</h2>", "<h3>{}</h3>", "<table><tr><td>{}</td></tr></table>", "<pre>{}</pre>").format(text))
            if rng.random() < 0.06:
                body.append(pick(ad, form, side, lambda: f'<div class="share social">{words(1, 5, "share", "tweet")}</div>')())
        return pick("<article>{}</article>", "<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', '<div id="main" class="post entry-content">{}</div>', '<main><article class="post">{}</article></main>', '<div class="article-body story">{}</div>', '<section class="page-content text">{}</section>').format("".join(body))

    front = [f() for f in (header, nav, notice, ad, side, form) if rng.random() < (0.7 if f is nav else 0.4 if f in (header, ad) else 0.2)]
    rear = [f() for f in (comments, side, ad, form, nav, footer, notice) if rng.random() < (0.8 if f is footer else 0.3 if f is comments else 0.15)]
    if rng.random() < 0.2:
        rng.shuffle(front)
    title = words(1, 12)
    page = f"<html><head><title>{title}</title><style>p{{}}</style><script>x</script></head><body>{''.join(front)}{article() if rng.random() < 0.97 else ''}{''.join(rear)}" + pick("</body></html>", "")
    return page, {" ".join(html.unescape(x).split()) for x in good}


def main_texts(w: dict, pages: list[str | None]) -> list[str]:
    """Article text of each page; pages of like length are read together."""
    cut = [blocks(p) if p else [] for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i in range(len(cut)) if cut[i]), key=lambda i: len(cut[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and end - at < PAGES_AT_ONCE and (end - at + 1) * len(cut[order[end]]) <= 20_000:
            end += 1
        some = order[at:end]
        z = forward(w, *_padded([vectors(cut[i]) for i in some]), keep=False)[0]
        for row, i in enumerate(some):
            out[i] = "\n".join(text for (_, text, _), keep in zip(cut[i], z[row], strict=False) if keep > 0)
        at = end
    return out


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages(page_id, url, html)``."""
    w = pages.sparkSession.sparkContext.broadcast(train())
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, PAGES_AT_ONCE):
                part = b.slice(i, PAGES_AT_ONCE)
                texts = main_texts(w.value, part.column("html").to_pylist())
                yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
