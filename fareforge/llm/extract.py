"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into its leaf blocks of text with the tags and class names above them. The field has two states, main text
and the rest; weights of ancestor and text features are learned together with those of neighbouring states from labelled
pages, and Viterbi decoding picks the states of a whole page at once.
"""
import html as entities
import json
import math
import random
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages to learn from, at most: those with the smallest digest of their id.
SAMPLE = 200
STEPS, RATE, PENALTY, SEED = 150, 0.2, 1e-3, 11
#: Fixed values of HTML: elements that stand in running text, that have no end tag, that leave a head open,
#: whose text is never shown.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike "
             "strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEAD = set("head html base link meta title style script noscript template basefont bgsound noframes".split())
HIDDEN = {"head", "script", "style", "template", "noscript", "svg", "title", "iframe", "object"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
#: What page authors call the parts around an article, and the article, in class names and ids.
ROLES = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs topbar toc tabs pagination pager",
    "header": "header masthead banner branding logo top",
    "footer": "footer bottom copyright colophon legal",
    "sidebar": "sidebar aside widget widgets rail related recommended trending popular more tags",
    "notice": "notice cookie cookies consent gdpr alert notification popup modal newsletter subscribe paywall disclaimer",
    "advert": "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion promoted",
    "form": "form search login signup contact poll",
    "comment": "comment comments reply replies discussion respond disqus reader readers commentlist feedback",
    "share": "share social sharing follow",
}
TAGS = {"menu": ["nav", "menu"], "header": ["header"], "footer": ["footer"], "sidebar": ["aside"], "form": ["form", "fieldset"]}
CONTENT = "article main content post entry body story text page single"

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(svg)(?=[\s/>])(?:[^>\"'/]|\"[^\"]*\"|'[^']*'|/(?!>))*+/>"
                    r"|<(script|style|template|noscript|svg|title|iframe|object)(?=[\s/>]).*?(?:</\2\s*>|\Z)"
                    r"|<[a-zA-Z/!?](?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|<[a-zA-Z/!?][^<>]*+>?|[^<]+|<", re.S | re.I)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_LABEL = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: list[tuple[str, tuple[str, ...]]]
    linked: int


def leaf_blocks(page: str) -> list[Block]:
    """Blocks of shown text in page order. Start and end tags of block elements end a block; end tags may be missing.

    A head without an end tag ends at the first text or element that it cannot hold."""
    blocks, stack, parts, linked, links = [], [], [], 0, 0

    def end():
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            blocks.append(Block(text, list(stack), linked))
        parts.clear()
        linked = 0

    def close(k):
        nonlocal links
        links -= sum(name == "a" for name, _ in stack[k:])
        del stack[k:]

    def leave_head():
        end()
        close(len(stack) - 1)

    for token in _TOKEN.finditer(page):
        piece = token.group()
        if piece[0] != "<" or len(piece) == 1:
            shown = entities.unescape(piece) if "&" in piece else piece
            if stack and stack[-1][0] == "head" and shown.strip():
                leave_head()
            parts.append(shown)
            if links:
                linked += len(shown)
            continue
        found = _NAME.match(piece)
        name = found[1].lower() if found else ""
        if found and piece[1] != "/" and name not in HEAD and stack and stack[-1][0] == "head":
            leave_head()
        if token.lastindex or not found:
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in INLINE:
            end()
        if piece[1] == "/":
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close(k)
                    break
            continue
        if name in VOID or piece.endswith("/>"):
            continue
        shut = CLOSES.get(name, set()) | ({"p"} if name not in INLINE else set())
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in shut:
                close(k)
                break
            if stack[k][0] not in INLINE:
                break
        labels = _LABEL.findall(piece) if "=" in piece else ()
        stack.append((name, tuple(w for x in labels for w in _PART.findall("".join(x).lower()))))
        links += name == "a"
    end()
    return [b for b in blocks if not any(name in HIDDEN for name, _ in b.path)]


def features(block: Block) -> list[str]:
    own = next((n for n, _ in reversed(block.path) if n not in INLINE), "body")
    out = {f"in:{n}" for n, _ in block.path if n not in INLINE} | {f"is:{own}"}
    out |= {f"named:{w}" for _, names in block.path for w in names}
    text = block.text
    out.add(f"length:{min(int(math.log2(len(text))), 10)}")
    out.add(f"linked:{min(4 * block.linked // len(text), 4)}")
    out.add("ends" if text[-1] in ".!?…:;\"”»" else "open")
    if "©" in text or "·" in text:
        out.add("sign")
    return sorted(out)


def weak_labels(blocks: list[Block]) -> list[int] | None:
    """States by the parts that a page names itself; None for pages that name no article."""
    rest = {w: 0 for names in ROLES.values() for w in names.split()} | {t: 0 for ts in TAGS.values() for t in ts}
    marked = [[n for n, _ in b.path] + [w for _, names in b.path for w in names] for b in blocks]
    if not any("article" in m or "main" in m for m in marked):
        return None
    return [int(("article" in m or "main" in m) and not any(w in rest for w in m)) for m in marked]


def composed_page(texts: list[str], rng: random.Random) -> tuple[list[Block], list[int]]:
    """A labelled page: an article in one of the usual containers, with usual parts before, inside and after it."""
    def pick():
        return rng.choice(texts)

    def short():
        return " ".join(pick().split()[:rng.randint(1, 12)]) or "x"

    def part(above):
        role = rng.choice(list(ROLES))
        name = rng.choice(ROLES[role].split())
        tag = rng.choice(TAGS[role]) if role in TAGS and rng.random() < 0.5 else rng.choice(["div", "section", "div", "ul", "p"])
        node = (tag, () if tag in sum(TAGS.values(), []) and rng.random() < 0.7 else (name,))
        if node[1] == () and tag in ("div", "section", "ul", "p"):
            node = (tag, (name,))
        rows = []
        for _ in range(rng.randint(1, 6)):
            linked = role in ("menu", "share") or rng.random() < 0.2
            text = short() if role in ("menu", "share", "footer") or rng.random() < 0.6 else pick()
            inner = [("ul", ()), ("li", ())] if role in ("menu", "sidebar") else [(rng.choice(["p", "div", "span", "li", "label", "h3"]), ())]
            rows.append((Block(text, above + [node] + (inner if rng.random() < 0.8 else []), len(text) if linked else 0), 0))
        return rows

    def article(above):
        rows = [(Block(short(), above + [(rng.choice(["h1", "h1", "h2"]), ())], 0), 1)] if rng.random() < 0.8 else []
        for _ in range(rng.randint(1, 9)):
            text = pick() if rng.random() < 0.85 else short()
            tag = rng.choice(["p"] * 8 + ["li", "blockquote", "h2", "h3", "pre", "td", "div"])
            rows.append((Block(text, above + [(tag, ())], 0), 1))
            if rng.random() < 0.06:
                rows += part(above)
        return rows

    body, rows = [("html", ()), ("body", ())], []
    for _ in range(rng.randint(0, 3)):
        rows += part(body)
    name = rng.choice(CONTENT.split())
    box = [(name, ())] if name in ("article", "main") and rng.random() < 0.7 else [(rng.choice(["div", "section"]), (name,))]
    if rng.random() < 0.3:
        box = [(rng.choice(["main", "div"]), ())] + box
    rows += article(body + box)
    for _ in range(rng.randint(0, 3)):
        rows += part(body + (box if rng.random() < 0.2 else []))
    return [b for b, _ in rows], [y for _, y in rows]


@dataclass
class Field:
    """weights: per feature one number per state; move: from state to state; first: of the first block."""
    weights: dict[str, tuple[float, float]]
    move: list[list[float]]
    first: list[float]

    def states(self, blocks: list[Block]) -> list[int]:
        """Viterbi."""
        if not blocks:
            return []
        score, back = None, []
        for b in blocks:
            e0 = e1 = 0.0
            for f in features(b):
                w = self.weights.get(f)
                if w:
                    e0 += w[0]
                    e1 += w[1]
            if score is None:
                score = (self.first[0] + e0, self.first[1] + e1)
                continue
            m = self.move
            a0, a1 = score[0] + m[0][0], score[1] + m[1][0]
            b0, b1 = score[0] + m[0][1], score[1] + m[1][1]
            back.append((int(a1 > a0), int(b1 > b0)))
            score = (max(a0, a1) + e0, max(b0, b1) + e1)
        path = [int(score[1] > score[0])]
        for step in reversed(back):
            path.append(step[path[-1]])
        return path[::-1]

    def text(self, page: str) -> str:
        blocks = leaf_blocks(page)
        return "\n".join(b.text for b, s in zip(blocks, self.states(blocks)) if s)


def learn(pages: list[tuple[list[list[str]], list[int]]]) -> Field:
    """Maximum likelihood with a squared penalty, by gradient steps over all pages at once (forward-backward)."""
    pages = [p for p in pages if p[0]]
    names = sorted({f for rows, _ in pages for row in rows for f in row})
    at = {f: i for i, f in enumerate(names)}
    longest = max((len(r) for r, _ in pages), default=1)
    n = len(pages)
    lengths = np.array([len(r) for r, _ in pages])
    page_of, place_of, feature_of = (np.array(x, int) for x in zip(*[
        (i, t, at[f]) for i, (rows, _) in enumerate(pages) for t, row in enumerate(rows) for f in row])) if n else ([], [], [])
    cell = np.asarray(page_of, int) * longest + np.asarray(place_of, int)
    y = np.zeros((n, longest), int)
    for i, (_, labels) in enumerate(pages):
        y[i, :len(labels)] = labels
    inside = np.arange(longest)[None] < lengths[:, None]
    gold = np.eye(2)[y] * inside[..., None]
    pairs = np.einsum("nta,ntb->ab", gold[:, :-1], gold[:, 1:])
    theta = [np.zeros((len(names), 2)), np.zeros((2, 2)), np.zeros(2)]
    square = [np.zeros_like(t) for t in theta]
    for _ in range(STEPS if n else 0):
        w, move, first = theta
        e = np.stack([np.bincount(cell, w[feature_of, k], n * longest).reshape(n, longest) for k in (0, 1)], axis=2)
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = first + e[:, 0]
        for t in range(1, longest):
            step = np.logaddexp.reduce(forward[:, t - 1, :, None] + move, axis=1) + e[:, t]
            forward[:, t] = np.where(inside[:, t, None], step, forward[:, t - 1])
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(move + (e[:, t + 1] + backward[:, t + 1])[:, None], axis=2)
            backward[:, t] = np.where(inside[:, t + 1, None], step, 0)
        p = np.exp(forward + backward - total[:, None, None]) * inside[..., None]
        both = np.exp(forward[:, :-1, :, None] + move + (e[:, 1:] + backward[:, 1:])[:, :, None] - total[:, None, None, None])
        expected = (both * inside[:, 1:, None, None]).sum(axis=(0, 1))
        off = (gold - p).reshape(-1, 2)[cell]
        grad_w = np.stack([np.bincount(feature_of, off[:, k], len(names)) for k in (0, 1)], axis=1)
        grads = [grad_w / n - PENALTY * w, (pairs - expected) / n - PENALTY * move, (gold - p)[:, 0].sum(axis=0) / n - PENALTY * first]
        for th, sq, g in zip(theta, square, grads):
            sq += g * g
            th += RATE * g / (np.sqrt(sq) + 1e-8)
    w, move, first = theta
    return Field({f: (float(w[i, 0]), float(w[i, 1])) for f, i in at.items()}, move.tolist(), first.tolist())


def train(pages: DataFrame, sample: int = SAMPLE) -> Field:
    """Learn from at most `sample` pages: as far as they name their parts, and recomposed into pages of other layouts
    with known labels. Tasks send feature names and labels, not pages."""
    chosen = pages.select("page_id", "html").orderBy(F.md5(F.col("page_id").cast("string")), "page_id", F.md5("html")).limit(sample)

    def labelled(batches):
        for b in batches:
            rows = []
            for page_id, page in zip(b["page_id"], b["html"]):
                blocks = leaf_blocks(page or "")
                states = weak_labels(blocks)
                if states:
                    rows.append(json.dumps([[features(x) for x in blocks], states]))
                texts = [x.text for x in blocks] or ["Text."]
                rng = random.Random(f"{SEED}:{page_id}")
                for _ in range(3):
                    made, y = composed_page(texts, rng)
                    rows.append(json.dumps([[features(x) for x in made], y]))
            yield pd.DataFrame({"page": rows})

    return learn([tuple(json.loads(r.page)) for r in sorted(chosen.mapInPandas(labelled, "page string").collect())])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages (page_id, url, html).

    Null, empty and text-free pages give ''. Rows that repeat a page are extracted each; other columns are ignored; an
    empty table gives an empty result. Line breaks by <br> are white space inside a block.
    """
    field = train(pages)

    @F.pandas_udf("string")
    def text(htmls: pd.Series) -> pd.Series:
        return htmls.fillna("").map(field.text)

    return pages.select("page_id", "url", text("html").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
