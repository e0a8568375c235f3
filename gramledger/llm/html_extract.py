"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page becomes the sequence of its leaf blocks: runs of text between block elements,
each with the elements it lies in. Features are the tags, class and id words and roles
of these ancestors and figures of the text (length, links, punctuation). The field has
two labels, main text or not, with weights per feature and label and per pair of
neighbouring labels; Viterbi finds the best sequence for the whole page.

It is trained here, by gradient steps on the conditional likelihood: on pages that
layouts() writes, of which every block's label is known, and on a bounded sample of
the given pages that mark their article with HTML5 elements.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramledger.llm.text import batch, utf8

SAMPLE = 1024  # most pages of the table that are learnt from
EPOCHS = 6
RATE = 0.3
DECAY = 1e-4

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
# Ends an open p element.
ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul".split()
)
# Ends open elements of the same kind up to the list or table they are in.
SIBLINGS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|select|object)\b.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.IGNORECASE)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Block:
    """A run of text: raw pieces, those inside links, and the features of what it lies in."""

    around: tuple[str, ...]
    tag: str
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def element_features(tag: str, attributes: str) -> tuple[str, ...]:
    found = [f"t:{tag}"]
    if attributes and not attributes.isspace():
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "role":
                found.append(f"r:{value.lower()}")
            elif name in ("class", "id"):
                found += [f"c:{w.lower().rstrip('s')}" for w in NAME_WORD.findall(value)]
            elif name == "hidden" or name == "aria-hidden" and value == "true" or "display:none" in value.replace(" ", ""):
                found.append("hidden")
    return tuple(found)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page that have text, in its order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    links = 0
    current: Block | None = None
    around: tuple[str, ...] = ()

    def changed() -> None:
        nonlocal current, around
        current = None
        around = tuple(dict.fromkeys(f for _, features in stack for f in features))

    def text(piece: str) -> None:
        nonlocal current
        if not piece or current is None and piece.isspace():
            return
        if current is None:
            current = Block(around, stack[-1][0] if stack else "")
            out.append(current)
        current.pieces.append(piece)
        if links:
            current.linked += len(piece)

    at = 0
    for m in MARKUP.finditer(page):
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if m["end"] else links + 1
        elif tag in VOID:
            if tag in ("br", "hr"):
                current = None
        elif m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    links = 0
                    break
            changed()
        else:
            if tag in ENDS_P:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        del stack[k:]
                        break
                    if stack[k][0] in ("div", "td", "th", "li", "section", "article", "button"):
                        break
            for k in range(len(stack) - 1, -1, -1) if tag in SIBLINGS else ():
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if stack[k][0] in SIBLINGS[tag]:
                    break
            if tag in ("body", "head") and any(t == "head" for t, _ in stack):
                stack = [s for s in stack if s[0] == "html"]
            links = 0
            stack.append((tag, element_features(tag, m["attrs"])))
            changed()
    text(page[at:])
    found = []
    for b in out:
        b.text = " ".join(html.unescape("".join(b.pieces)).split())
        if b.text:
            found.append(b)
    return found


def features(b: Block) -> list[str]:
    n = b.text.count(" ") + 1
    share = min(1.0, b.linked / max(1, sum(map(len, b.pieces))))
    found = [*b.around, f"leaf:{b.tag}", f"n:{min(6, n.bit_length())}", f"link:{round(share * 3)}", "bias"]
    if b.text[-1] in ".!?…":
        found.append("stop")
    if "©" in b.text or "|" in b.text:
        found.append("mark")
    return found


class Field:
    """Weights of the label 1 against 0 by feature, and of neighbouring labels."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.squares: dict[str, float] = {}

    def scores(self, page: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum(get(f, 0.0) for f in block) for block in page]

    def pair(self, a: int, b: int) -> float:
        return self.weights.get(f"pair:{a}{b}", 0.0)

    def decode(self, page: list[list[str]]) -> list[int]:
        """The labels of the best sequence (Viterbi)."""
        scores = self.scores(page)
        if not scores:
            return []
        pairs = [[self.pair(a, b) for b in (0, 1)] for a in (0, 1)]
        best, back = [0.0, scores[0]], []
        for s in scores[1:]:
            came = [0 if best[0] + pairs[0][b] >= best[1] + pairs[1][b] else 1 for b in (0, 1)]
            back.append(came)
            best = [best[came[b]] + pairs[came[b]][b] + (s if b else 0.0) for b in (0, 1)]
        labels = [int(best[1] > best[0])]
        for came in reversed(back):
            labels.append(came[labels[-1]])
        return labels[::-1]

    def step(self, page: list[list[str]], labels: list[int], rate: float = RATE) -> None:
        """One gradient step on the log-likelihood of the labels, by forward and backward sums."""
        scores, n = self.scores(page), len(page)
        pairs = [[self.pair(a, b) for b in (0, 1)] for a in (0, 1)]

        def both(x: float, y: float) -> float:
            top = max(x, y)
            return top + math.log1p(math.exp(min(x, y) - top))

        forward = [(0.0, scores[0])]
        for s in scores[1:]:
            f = forward[-1]
            forward.append(tuple(both(f[0] + pairs[0][b], f[1] + pairs[1][b]) + (s if b else 0.0) for b in (0, 1)))
        backward = [(0.0, 0.0)]
        for s in reversed(scores[1:]):
            g = backward[-1]
            backward.append(tuple(both(pairs[a][0] + g[0], pairs[a][1] + s + g[1]) for a in (0, 1)))
        backward.reverse()
        whole = both(*forward[-1])
        change: dict[str, float] = {}
        for i in range(n):
            error = labels[i] - math.exp(min(0.0, forward[i][1] + backward[i][1] - whole))
            if abs(error) > 1e-6:
                for f in page[i]:
                    change[f] = change.get(f, 0.0) + error
            if i:
                for a in (0, 1):
                    for b in (0, 1):
                        p = math.exp(min(0.0, forward[i - 1][a] + pairs[a][b] + (scores[i] if b else 0.0) + backward[i][b] - whole))
                        key = f"pair:{a}{b}"
                        change[key] = change.get(key, 0.0) + (labels[i - 1] == a and labels[i] == b) - p
        for f, g in change.items():
            w = self.weights.get(f, 0.0)
            g -= DECAY * w
            total = self.squares[f] = self.squares.get(f, 1e-2) + g * g
            self.weights[f] = w + rate * g / math.sqrt(total)


# -- labelled pages -------------------------------------------------------------

# Names for parts of a page that are not its text, and for those that are.
ASIDE = (
    "ad ads advert advertisement banner breadcrumb byline-share cookie cookie-notice consent notice alert comment comments "
    "comment-list disqus reply related recommended sidebar widget menu navbar nav navigation pagination pager popup modal promo "
    "sponsor sponsored newsletter subscribe signup login search share social toolbar footer header masthead copyright tags"
).split()
TEXT = "content article post entry story body main text article-body post-content entry-content".split()
ROLES = "navigation banner contentinfo complementary search dialog alert".split()


def layouts(seed: int = 7, n: int = 1000) -> Iterator[tuple[list[list[str]], list[int]]]:
    """Labelled pages: layouts drawn at random of parts that are text and parts that are not."""
    draw = random.Random(seed)

    def words(low: int, high: int, stop: bool) -> str:
        return " ".join("".join(draw.choice("aeinorst") for _ in range(draw.randint(2, 8))) for _ in range(draw.randint(low, high))) + "." * stop

    def name() -> str:
        return f' {draw.choice(("class", "id"))}="{draw.choice(ASIDE)}"'

    def aside() -> str:
        """A part that is not text. Its lengths and sentences are those of text: what it lies in tells."""
        tag = draw.choice(("nav", "header", "footer", "aside", "form", "div", "div", "div", "section", "ul"))
        attrs = name() if tag in ("div", "section", "ul") or draw.random() < 0.3 else ""
        if tag == "div" and draw.random() < 0.2:
            attrs = draw.choice((f' role="{draw.choice(ROLES)}"', " hidden"))
        inner = "".join(
            draw.choice((f"<a href='#'>{words(1, 3, False)}</a>", f"<p>{words(3, 60, True)}</p>", words(1, 30, draw.random() < 0.7)))
            if tag != "ul" else f"<li><a href='#'>{words(1, 3, False)}</a></li>"
            for _ in range(draw.randint(1, 4)))
        return f"<{tag}{attrs}>\u0001{inner}\u0002</{tag}>"

    def body() -> str:
        parts = [f"<h1>{words(1, 12, draw.random() < 0.5)}</h1>"] if draw.random() < 0.9 else []
        for _ in range(draw.randint(1, 12)):
            tag = draw.choice(("p", "p", "p", "p", "p", "h2", "blockquote", "li", "pre"))
            inner = words(1, 90, draw.random() < 0.8)
            if draw.random() < 0.2:
                inner = f"<b>{inner}</b><br>" if draw.random() < 0.5 else f"{inner} <a href='#'>{words(1, 3, False)}</a>"
            parts.append(f"<ul><li>{inner}</li></ul>" if tag == "li" else f"<{tag}>{inner}</{tag}>")
            if draw.random() < 0.3:
                parts.append(aside())
        return "".join(parts)

    for _ in range(n):
        tag, attrs = draw.choice((("article", ""), ("main", ""), *[("div", f' class="{draw.choice(TEXT)}"')] * 3, ("section", f' id="{draw.choice(TEXT)}"')))
        inner = f"<{tag}{attrs}>{body()}</{tag}>"
        if draw.random() < 0.3:
            inner = f'<div class="{draw.choice(("page", "wrap", "container"))}">{inner}</div>'
        if draw.random() < 0.2:
            inner = f"<main>{inner}</main>"
        page = "".join(aside() for _ in range(draw.randint(0, 3))) + inner + "".join(aside() for _ in range(draw.randint(0, 3)))
        page = f"<html><head><title>\u0001{words(2, 9, False)}\u0002</title></head><body>{page}</body></html>"
        yield labelled(page)


def labelled(page: str) -> tuple[list[list[str]], list[int]]:
    """Features and labels of a page in which U+0001 and U+0002 enclose what is not text."""
    found, labels, depth = [], [], 0
    for b in blocks(page):
        raw = "".join(b.pieces)
        inside = depth > 0 or "\u0001" in raw
        depth += raw.count("\u0001") - raw.count("\u0002")
        b.text = b.text.replace("\u0001", "").replace("\u0002", "").strip()
        if b.text:
            found.append(features(b))
            labels.append(0 if inside else 1)
    return found, labels


NOT_TEXT = frozenset(["t:nav", "t:footer", "t:aside", "t:form", "t:head", "t:title", "hidden", *(f"c:{w.rstrip('s')}" for n in ASIDE for w in n.split("-")),
                      *(f"r:{r}" for r in ROLES)])


def marked(page: str) -> tuple[list[list[str]], list[int]] | None:
    """Features and labels of a page that marks its article, by the elements its blocks lie in; else None."""
    found = [b for b in blocks(page)]
    if not any("t:article" in b.around for b in found):
        return None
    return [features(b) for b in found], [int("t:article" in b.around and NOT_TEXT.isdisjoint(b.around)) for b in found]


def train(pages: list[str]) -> dict[str, float]:
    """Weights learnt from layouts() and from those of the pages that mark their article."""
    rows = [*layouts(), *filter(None, map(marked, pages))]
    rows = [(f, labels) for f, labels in rows if f]
    model, draw = Field(), random.Random(1)
    for epoch in range(EPOCHS):
        draw.shuffle(rows)
        for f, labels in rows:
            model.step(f, labels, RATE / (1 + epoch))
    return model.weights


def main_text(page: str, model: Field) -> str:
    found = blocks(page)
    labels = model.decode([features(b) for b in found])
    return "\n".join(b.text for b, label in zip(found, labels, strict=True) if label)


# -- over tables ----------------------------------------------------------------

EXTRACTED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.large_string()), ("n_chars", pa.int64())])


def learn(pages: DataFrame, *, page_id: str = "page_id", page_html: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Weights from at most `sample` pages, those whose ids' hashes come first, in one task."""
    ids = pages.select(F.col(page_id).cast("bigint").alias("key")).where("key IS NOT NULL").distinct().orderBy(F.xxhash64("key"), "key").limit(sample)
    rows = pages.select(F.col(page_id).cast("bigint").alias("id"), utf8(page_html).alias("html"))
    # No more than `sample` ids: that is the bound for sending them to all tasks.
    rows = rows.join(F.broadcast(ids), F.col("id") == F.col("key")).groupBy("id").agg(F.min("html").alias("html"))
    rows = rows.select("html", "id").coalesce(1).sortWithinPartitions("id")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [(x.as_py() or b"").decode("utf-8", "replace") for b in batches for x in b.column(0)]
        weights = train(texts)
        yield batch(pa.schema([("f", pa.string()), ("w", pa.float64())]), [list(weights), list(weights.values())])

    weights = {r.f: r.w for r in rows.mapInArrow(fit, "f string, w double").collect()}  # names in a bounded sample
    return weights or train([])


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", page_html: str = "html", weights: dict[str, float] | None = None) -> DataFrame:
    """page_id, url, text, n_chars: the main text of every row of pages.

    Character references are decoded, white space within a block becomes one space, and
    blocks are joined by line ends. Null, empty and text-less pages have an empty text.
    Repeated rows give repeated results; null ids and urls stay null; an empty table
    gives no rows. Bytes that are no UTF-8 are read as U+FFFD. Other columns are not read.
    """
    sent = pages.sparkSession.sparkContext.broadcast(learn(pages, page_id=page_id, page_html=page_html) if weights is None else weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Field()
        model.weights = sent.value
        for rows in batches:
            texts = [main_text((x.as_py() or b"").decode("utf-8", "replace"), model) for x in rows.column(2)]
            yield batch(EXTRACTED, [rows.column(0), rows.column(1), texts, [len(t) for t in texts]])

    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), utf8(page_html).alias("html"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
