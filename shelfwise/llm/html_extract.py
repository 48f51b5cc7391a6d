"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page.

Method: a page becomes its leaf blocks in order. Features of a block are the tags around it, class and id words of
its ancestors, its nearest tag, and text shape (length, share of link text, end punctuation, place in the page);
they are hashed into a fixed number of weights. The field has two labels, text and rest, with weights for each
label's features and for pairs of neighbouring labels. It is trained by stochastic gradient on the log-likelihood
(forward-backward) and decoded by Viterbi. The main text is the text blocks joined by blanks.

Training pages: no table has labels for pages, so ``labelled_pages`` writes ``TRAINING_PAGES`` pages with known
labels (article text; menus, headers, footers, sidebars, notices, adverts, forms, reader comments in many markups
and word shapes). Training runs on the driver over that fixed number; the weights (``WEIGHTS`` numbers) are broadcast.

Cases: null, empty or textless html gives an empty text; broken markup is read as far as it goes; very long blocks
are kept whole; repeated rows and null ids pass through; an empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import ship
from shelfwise.llm.html_blocks import WEIGHTS, Block, blocks, slot
from shelfwise.llm.tables import append_column, free_name

TRAINING_PAGES = 700
EPOCHS = 6


def block_features(page: list[Block]) -> list[list[int]]:
    """Hashed features of every block of a page."""
    out = []
    n = len(page)
    for i, b in enumerate(page):
        size = len(b.text)
        words = b.text.count(" ") + 1
        names = ["bias", f"size:{min(int(np.log2(size + 1)), 9)}", f"words:{min(words.bit_length(), 8)}",
                 f"links:{round(4 * b.linked / max(size - words + 1, 1))}", f"end:{b.text[-1] if not b.text[-1].isalnum() else 'w'}",
                 f"start:{'A' if b.text[0].isupper() else 'a' if b.text[0].isalpha() else b.text[0]}",
                 "first" if i < 2 else "inner", "last" if i >= n - 2 else "inner2"]
        names += [f"at:{b.near}", f"at:{b.near}:{min(words.bit_length(), 8)}"] if b.near else []
        out.append(list(dict.fromkeys([*map(slot, names), *b.around])))
    return out


class Field:
    """Two-label linear chain: feature weights (label, slot) and neighbour weights (label, next label)."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray):
        self.weights, self.pairs = weights, pairs

    def scores(self, features: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[:, f].sum(axis=1) for f in features]).reshape(-1, 2)

    def decode(self, features: list[list[int]]) -> list[int]:
        """Most probable labels, by Viterbi; of equal paths the one with the lower label."""
        if not features:
            return []
        (a, b), *rest = self.scores(features).tolist()
        (p00, p01), (p10, p11) = self.pairs.tolist()
        back = []
        for s0, s1 in rest:
            back.append((int(b + p10 > a + p00), int(b + p11 > a + p01)))
            a, b = s0 + max(a + p00, b + p10), s1 + max(a + p01, b + p11)
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    def marginals(self, features: list[list[int]]) -> tuple[np.ndarray, np.ndarray, float]:
        """Label marginals, neighbour marginals summed over the page, and the log partition."""
        s = self.scores(features)
        n = len(s)
        fore, aft = np.zeros((n, 2)), np.zeros((n, 2))
        fore[0] = s[0]
        for i in range(1, n):
            m = fore[i - 1][:, None] + self.pairs
            fore[i] = s[i] + np.logaddexp(m[0], m[1])
        for i in range(n - 2, -1, -1):
            m = self.pairs + (s[i + 1] + aft[i + 1])[None, :]
            aft[i] = np.logaddexp(m[:, 0], m[:, 1])
        z = float(np.logaddexp(*fore[-1]))
        both = np.zeros((2, 2))
        if n > 1:
            inner = fore[:-1, :, None] + self.pairs[None] + (s[1:] + aft[1:])[:, None, :]
            both = np.exp(inner - z).sum(axis=0)
        return np.exp(fore + aft - z), both, z


def train(pages: list[tuple[list[list[int]], list[int]]], epochs: int = EPOCHS, rate: float = 0.3, l2: float = 1e-5) -> Field:
    """Stochastic gradient (AdaGrad) on the pages' log-likelihood, in a fixed order of shuffles."""
    field = Field(np.zeros((2, WEIGHTS)), np.zeros((2, 2)))
    square, square_pairs = np.full((2, WEIGHTS), 1e-6), np.full((2, 2), 1e-6)
    order = [i for i, (f, _) in enumerate(pages) if f]
    rng = random.Random(5)
    for _ in range(epochs):
        rng.shuffle(order)
        for i in order:
            features, labels = pages[i]
            single, both, _ = field.marginals(features)
            grad = -single
            grad[np.arange(len(labels)), labels] += 1
            slots = np.concatenate([np.array(f) for f in features])
            rows = np.repeat(np.arange(len(features)), [len(f) for f in features])
            used, where = np.unique(slots, return_inverse=True)
            for label in (0, 1):
                g = np.bincount(where, grad[rows, label]) - l2 * field.weights[label, used]
                square[label, used] += g * g
                field.weights[label, used] += rate * g / np.sqrt(square[label, used])
            seen = np.zeros((2, 2))
            np.add.at(seen, (labels[:-1], labels[1:]), 1)
            g = seen - both
            square_pairs += g * g
            field.pairs += rate * g / np.sqrt(square_pairs)
    return field


# ---- labelled pages
#: fixed values: class and id words that sites use, by what the part holds
PARTS = {
    "menu": "nav menu navbar navigation topnav breadcrumbs breadcrumb links tabs pager pagination toc".split(),
    "header": "header masthead banner top site logo branding".split(),
    "footer": "footer foot bottom copyright legal colophon".split(),
    "sidebar": "sidebar side aside widget related recommended popular trending more teaser rail".split(),
    "notice": "notice cookie cookies consent gdpr alert warning popup modal overlay paywall message".split(),
    "advert": "ad ads advert advertisement sponsored sponsor promo promotion banner commercial".split(),
    "form": "form search newsletter subscribe signup login register contact poll".split(),
    "comments": "comments comment replies reply discussion respond thread disqus feedback".split(),
    "share": "share social sharing follow tags meta byline author date".split(),
}
MAIN = "article content post entry body main text story page single hentry".split()


def _markup(r: random.Random, kind: str, inner: str) -> str:
    tag = {"menu": ["nav", "div", "ul", "nav"], "header": ["header", "div"], "footer": ["footer", "div", "footer"],
           "sidebar": ["aside", "div", "section"], "notice": ["div", "section", "aside", "p"], "advert": ["div", "aside", "ins", "section"],
           "form": ["form", "form", "div"], "comments": ["section", "div", "ol"], "share": ["div", "ul"]}[kind]
    tag = r.choice(tag)
    own = tag in ("nav", "header", "footer", "aside", "form")
    names = [r.choice(PARTS[kind])] + ([r.choice(["box", "wrap", "inner", "block", "col", "left"])] if r.random() < .3 else [])
    attr = "" if own and r.random() < .5 else f' {r.choice(["class", "class", "id"])}="{r.choice(["-", " ", "_"]).join(names)}"'
    return f"<{tag}{attr}>{inner}</{tag}>"


def labelled_pages(n: int, seed: int) -> list[tuple[str, list[str]]]:
    """``n`` pages and the text blocks that are their main text, in order."""
    r = random.Random(seed)
    sounds = [["th", "an", "er", "on", "in", "st", "re", "ou"], ["ción", "os", "ar", "ñ", "que", "la"], ["sch", "ung", "keit", "ü", "er", "ß"],
              ["eau", "è", "ai", "ré", "ou", "ç"], ["ka", "to", "mi", "ru", "ne", "sa"]]
    pages = []
    for _ in range(n):
        voice = r.choice(sounds)
        word = lambda: "".join(r.choice(voice) for _ in range(r.randint(1, 4)))

        def sentence(low=4, high=16):
            return " ".join(word() for _ in range(r.randint(low, high))).capitalize() + r.choice("....?!")

        def links(tag="li"):
            return "".join(f'<{tag}><a href="/{word()}">{r.choice([word, lambda: word().capitalize(), lambda: word() + "."])()}</a></{tag}>'
                           for _ in range(r.randint(2, 8)))

        def part(kind):
            prose = "".join(f"<p>{sentence()} {sentence()}</p>" if r.random() < .5 else sentence(3, 12) for _ in range(r.randint(1, 2)))
            inner = {
                "menu": f"<ul>{links()}</ul>" if r.random() < .8 else links("span"), "header": f"<h1>{sentence(1, 4)}</h1>{links('span')}" if r.random() < .5 else sentence(1, 5),
                "footer": f"&copy; {word()}.example.{r.choice(['com', 'net', 'org'])} &middot; {sentence()} {sentence(2, 5)}" if r.random() < .6 else f"<p>{sentence()}</p><ul>{links()}</ul>",
                "sidebar": f"<h3>{word()}</h3><ul>{links()}</ul>" if r.random() < .5 else f"<h3>{word()}</h3>{prose}", "notice": prose + (f"<button>{word()}</button>" if r.random() < .5 else ""),
                "advert": sentence(3, 12) if r.random() < .6 else prose, "form": f"<label>{word()}</label><input><p>{sentence(2, 8)}</p><button>{word()}</button>",
                "comments": "".join(f'<div class="{r.choice(["comment", "reply", "item"])}"><b>{word()}</b><p>{sentence()} {sentence()}</p></div>' for _ in range(r.randint(1, 4))),
                "share": links("span") if r.random() < .5 else f"<span>{word()} {r.randint(1, 30)} {word()} 20{r.randint(10, 25)}</span>"}[kind]
            return _markup(r, kind, inner)

        main: list[str] = []

        def body():
            out = []
            if r.random() < .7:
                title = sentence(3, 12)[:60].strip()
                main.append(title)
                out.append(f"<{'h1' if r.random() < .8 else 'h2'}>{title}</h1>" if r.random() < .1 else f"<h1>{title}</h1>")
            for _ in range(r.randint(1, 9)):
                text = " ".join(sentence(1, 16) for _ in range(r.choice([1, 1, 2, 4, 8])))
                x = r.random()
                if x < .06:
                    items = [sentence(3, 9) for _ in range(r.randint(2, 4))]
                    main.extend(items)
                    out.append("<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>")
                    continue
                if x < .1:
                    text = sentence(2, 5)[:-1]
                    out.append(f"<h2>{text}</h2>")
                elif x < .14:
                    out.append(f"<blockquote>{text}</blockquote>")
                elif x < .2:
                    out.append(f"<p><b>{text}<br>")
                elif x < .26:
                    a, b = text[:len(text) // 2], text[len(text) // 2:]
                    out.append(f'<p>{a}<a href="#">{b}</a></p>')
                else:
                    out.append(f"<p>{text}</p>")
                main.append(text)
                if r.random() < .06:
                    out.append(part(r.choice(["advert", "notice", "share", "sidebar", "form"])))
            return "".join(out)

        before = [part(k) for k in ("notice", "header", "menu", "advert", "share", "form") if r.random() < (.8 if k == "menu" else .4)]
        r.shuffle(before)
        tag = r.choice(["article", "article", "main", "div", "section"])
        attr = f' {r.choice(["class", "id"])}="{r.choice(MAIN)}{r.choice(["", "-" + r.choice(MAIN), " " + r.choice(["wrap", "inner", "box"])])}"'
        inner = f"<{tag}{'' if tag in ('article', 'main') and r.random() < .6 else attr}>{body()}</{tag}>"
        after = [part(k) for k in ("share", "sidebar", "comments", "advert", "footer") if r.random() < (.85 if k == "footer" else .4)]
        html = f"<html><head><title>{sentence(2, 8)}</title><script>var a='<p>x</p>';</script></head><body>{''.join(before)}{inner}{''.join(after)}"
        pages.append((html + ("</body></html>" if r.random() < .8 else ""), [" ".join(t.split()) for t in main]))
    return pages


def labels_of(page: list[Block], main: list[str]) -> list[int]:
    """1 for the blocks that are the main texts, taken in order."""
    out, k = [], 0
    for b in page:
        hit = k < len(main) and b.text == main[k]
        out.append(int(hit))
        k += hit
    return out


def trained_field(n: int = TRAINING_PAGES, seed: int = 17) -> Field:
    examples = []
    for html, main in labelled_pages(n, seed):
        page = blocks(html)
        examples.append((block_features(page), labels_of(page, main)))
    return train(examples)


def page_text(html: str | None, field: Field) -> str:
    page = blocks(html)
    return " ".join(b.text for b, label in zip(page, field.decode(block_features(page))) if label)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""
    shared = pages.sparkSession.sparkContext.broadcast(field or trained_field())  # 2 * WEIGHTS numbers

    def kernel(html):
        return pa.array([page_text(x.as_py(), shared.value) for x in html], pa.string())
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    out = free_name(rows, "text")
    return append_column(rows, out, "string", ["html"], kernel).select(
        "page_id", "url", F.col(out).alias("text"), F.char_length(out).cast("long").alias("n_chars"))


ship(__name__)
