"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into blocks of text between block-level tags. Each block is described by its
ancestors (tags and the words of their class and id names) and by its text; neighbouring
blocks influence each other's label, and Viterbi decoding finds the likeliest labels of the
whole page. The model is trained on pages whose labels are known because they were laid out
from templates (``labelled_pages``).
"""

import html
import random
import re
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

#: Tags that end the text before them. Fixed values of HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Content of these is never text of the page. Fixed values of HTML.
RAW_TAGS = frozenset(
    "script style noscript template svg canvas iframe object audio video textarea title head annotation annotation-xml".split()
)
_RAW_TEXT = frozenset("script style textarea title iframe noscript".split())
#: An open head ends at the start of any other tag, and at text. Fixed values of HTML.
_HEAD_TAGS = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open tag of the left kind is closed by the start of one of the right. Fixed values of HTML.
_ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
_CLOSED_BY = {
    "p": _ENDS_P,
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option", "optgroup"},
}
_FORMATS = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())

#: Labelled pages the model is trained on, the shares of bare ones and of tables, and passes over them.
PAGES = 900
BARE, TABLES = 0.15, 0.08
EPOCHS = 6
RATE = 0.3
SEED = 5

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"""(?:\s|^)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_SPACES = re.compile(r"\s+")


def _of_tag(tag, attrs):
    """Features an ancestor gives to the blocks below it."""
    # Long attributes are rarely met twice; kept, they would fill memory.
    return _read_tag(tag, attrs) if len(attrs) < 512 else _read_tag.__wrapped__(tag, attrs)


@lru_cache(4096)
def _read_tag(tag, attrs):
    found = [f"tag={tag}"]
    for name, a, b, c in _NAMES.findall(attrs):
        for word in _NAME_WORD.findall(a or b or c):
            found.append(f"name={word.lower()}")
    if _HIDDEN.search(attrs):
        found.append("hidden")
    return tuple(dict.fromkeys(found))


class _Open(NamedTuple):
    """An open tag, with what the blocks inside it take from it and the tags around it."""

    tag: str
    solid: int  # place in the stack of the nearest tag that is no format, itself included; -1 without
    above: tuple  # features of all tags
    nearest: tuple  # features of the nearest named part


_NOTHING = _Open("", -1, (), ())


def blocks(page, known=None):
    """Text blocks of a page: ``(text, characters inside links, ancestors' features)``.

    Tags left open are closed as browsers do; tags closed without being open are ignored.
    With ``known``, a container, features that it doesn't hold are left out; then a page costs time
    in proportion to its length, however deep its tags go.
    """
    out, stack = [], []
    text, linked = [], 0
    raw_depth = 0
    opened = Counter()

    def flush():
        nonlocal text, linked
        joined = _SPACES.sub(" ", "".join(text)).strip()
        if joined:
            inner = stack[-1] if stack else _NOTHING
            out.append((joined, linked, inner.above + inner.nearest))
        text, linked = [], 0

    def add(piece):
        nonlocal linked
        if opened["head"] and stack[-1].tag == "head" and piece.strip():
            pop()
        if piece and not raw_depth:
            piece = html.unescape(piece)
            text.append(piece)
            if opened["a"]:
                linked += len(piece.strip())

    def pop():
        nonlocal raw_depth
        tag = stack.pop().tag
        opened[tag] -= 1
        raw_depth -= tag in RAW_TAGS

    def push(tag, features):
        nonlocal raw_depth
        around = stack[-1] if stack else _NOTHING
        told = [f for f in features if known is None or f in known]
        new = tuple(f for f in told if f not in around.above)
        above, nearest, solid = around.above + new if new else around.above, around.nearest, around.solid
        if tag not in _FORMATS:
            solid = len(stack)
            # The nearest named part says most about a block.
            if len(features) > 1:
                nearest = tuple(f"nearest {f}" for f in features)
                nearest = nearest if known is None else tuple(f for f in nearest if f in known)
        stack.append(_Open(tag, solid, above, nearest))
        opened[tag] += 1
        raw_depth += tag in RAW_TAGS

    at, end = 0, len(page)
    while at < end:
        found = _MARKUP.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        tag = found["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            text.append(" ")
            continue
        if opened["head"] and stack[-1].tag == "head" and tag not in _HEAD_TAGS and not found["close"]:
            pop()
        if tag in BLOCK_TAGS or tag in ("head", "title"):
            flush()
        if found["close"]:
            if opened[tag]:
                # A format left open inside ends with the block around it.
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        if tag in VOID_TAGS:
            continue
        while stack and stack[-1].solid >= 0:
            solid = stack[-1].solid
            if tag not in _CLOSED_BY.get(stack[solid].tag, ()):
                break
            while len(stack) > solid:
                pop()
        if found["attrs"].endswith("/") and tag in ("svg", "math"):
            continue
        push(tag, _of_tag(tag, found["attrs"]))
        if tag in _RAW_TEXT:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = close.start() if close else end
    flush()
    return out


_SENTENCE = re.compile(r"[.!?…。]['\"»”)]*$")
_MARKS = re.compile(r"[,;:]")


def _of_text(text, linked, position):
    """Features of a block's own text."""
    words = text.count(" ") + 1
    found = ["any", f"words={min(int(np.log2(words)), 7)}"]
    share = linked / max(1, len(text))
    found.append("links=all" if share > 0.8 else "links=some" if share > 0.2 else "links=few" if linked else "links=no")
    found.append("sentence" if _SENTENCE.search(text) else "no sentence")
    if words > 5 and _MARKS.search(text):
        found.append("commas")
    if "©" in text or "(c)" in text.lower():
        found.append("copyright")
    if any(c.isdigit() for c in text):
        found.append("digits")
    if "|" in text or "·" in text or "›" in text or "»" in text:
        found.append("separators")
    if text[:1].islower():
        found.append("lower")
    found.append(f"place={min(4, int(position * 5))}")
    return found


class Field:
    """Weights of features and of label pairs; label 1 is main text."""

    def __init__(self, weights=None, pairs=None, ends=None):
        self.weights = weights if weights is not None else {}
        self.pairs = pairs if pairs is not None else np.zeros((2, 2))
        self.ends = ends if ends is not None else np.zeros((2, 2))

    @staticmethod
    def features(page_blocks):
        n = len(page_blocks)
        return [[*_of_text(text, linked, i / n), *above] for i, (text, linked, above) in enumerate(page_blocks)]

    def unary(self, features):
        """Scores for label 1 over label 0."""
        get = self.weights.get
        return np.array([sum(get(f, 0.0) for f in fs) for fs in features])

    def decode(self, score):
        """The likeliest labels of a page, by Viterbi."""
        (p00, p01), (p10, p11) = self.pairs.tolist()
        (b0, b1), (e0, e1) = self.ends.tolist()
        s = score.tolist()
        zero, one = b0, b1 + s[0]
        back = []
        for x in s[1:]:
            from0 = zero + p00 >= one + p10
            from1 = zero + p01 > one + p11
            back.append((0 if from0 else 1, 0 if from1 else 1))
            zero, one = (zero + p00 if from0 else one + p10), (zero + p01 if from1 else one + p11) + x
        label = int(one + e1 > zero + e0)
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]

    def marginals(self, score):
        """Probabilities of labels and of label pairs, by forward and backward sums."""
        n = len(score)
        unary = np.stack([np.zeros(n), score], 1)
        ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[0] = unary[0] + self.ends[0]
        for i in range(1, n):
            ahead[i] = unary[i] + np.logaddexp(ahead[i - 1, 0] + self.pairs[0], ahead[i - 1, 1] + self.pairs[1])
        behind[-1] = self.ends[1]
        for i in range(n - 2, -1, -1):
            after = unary[i + 1] + behind[i + 1]
            behind[i] = np.logaddexp(self.pairs[:, 0] + after[0], self.pairs[:, 1] + after[1])
        total = np.logaddexp(*(ahead[-1] + behind[-1]))
        single = np.exp(ahead + behind - total)
        double = np.zeros((2, 2))
        if n > 1:
            joint = ahead[:-1, :, None] + self.pairs[None] + (unary[1:] + behind[1:])[:, None, :]
            double = np.exp(joint - total).sum(0)
        return single, double


def fit(pages, epochs=EPOCHS, rate=RATE):
    """Maximises the likelihood of ``(blocks, labels)`` by AdaGrad steps, a page at a time."""
    field, rng = Field(), np.random.default_rng(SEED)
    data = [(Field.features(b), np.array(y)) for b, y in pages if len(y)]
    seen, pair_seen, end_seen = {}, np.full((2, 2), 1e-6), np.full((2, 2), 1e-6)
    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            features, labels = data[k]
            single, double = field.marginals(field.unary(features))
            pull = {}
            for fs, g in zip(features, labels - single[:, 1]):
                for f in fs:
                    pull[f] = pull.get(f, 0.0) + g
            for f, g in pull.items():
                g -= 1e-3 * field.weights.get(f, 0.0)
                seen[f] = seen.get(f, 1e-6) + g * g
                field.weights[f] = field.weights.get(f, 0.0) + rate * g / seen[f] ** 0.5
            true = np.zeros((2, 2))
            np.add.at(true, (labels[:-1], labels[1:]), 1)
            step = true - double
            pair_seen += step**2
            field.pairs += rate * step / np.sqrt(pair_seen)
            step = np.eye(2)[[labels[0], labels[-1]]] - single[[0, -1]]
            end_seen += step**2
            field.ends += rate * step / np.sqrt(end_seen)
    return field


#: Words that class and id names of page parts are made of, for the labelled pages.
_PARTS = {
    "nav": "nav navbar navigation menu topnav breadcrumb breadcrumbs pagination pager tabs toolbar sitemap toc",
    "header": "header masthead banner top logo brand branding site hero",
    "footer": "footer bottom copyright colophon legal credits imprint",
    "aside": "sidebar aside widget related popular recommended trending teaser more side rail secondary",
    "ad": "ad ads advert advertisement adsense sponsored sponsor promo promotion commercial banner",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay newsletter subscribe paywall warning message",
    "form": "form search login signup contact subscribe newsletter",
    "comments": "comments comment replies reply respond discussion disqus feedback reviews thread",
    "share": "share social sharing follow tags meta tools print",
}
_CONTENT = "article content post entry story main body text page article-body post-content entry-content blog news maincontent".split()
_NEUTRAL = "wrapper container row col inner outer box block section wrap layout grid site page".split()
_SEMANTIC = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}


def _prose(rng, words):
    """Invented words: the model must not learn a vocabulary."""
    syllables = "an be ca do en fi go ha in jo ka le mo na or pa qui re so ta um ve wo xi yn zu ér ß".split()
    made = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return made


def _sentences(rng, low, high):
    words = _prose(rng, rng.randint(low, high))
    out, start = [], True
    for i, w in enumerate(words):
        out.append(w.capitalize() if start else w)
        start = False
        if i == len(words) - 1 or rng.random() < 0.1:
            out[-1] += rng.choice("....!?")
            start = True
        elif rng.random() < 0.1:
            out[-1] += ","
    return " ".join(out)


def _short(rng, most=4):
    return " ".join(_prose(rng, rng.randint(1, most))).capitalize()


def _named(rng, part):
    name = rng.choice(_PARTS[part].split())
    if rng.random() < 0.4:
        name += rng.choice(["-", "_", " "]) + rng.choice([*_NEUTRAL, "list", "item", "main", "bar", "area"])
    return rng.choice([f' class="{name}"', f' id="{name}"', f" class='{name}'"])


def _part(rng, part, cell=False):
    """A part of a page that is not main text; as a table's cell, if so wanted."""
    tag = _SEMANTIC.get(part)
    attrs = "" if tag and rng.random() < 0.5 else _named(rng, part)
    tag = tag if tag and rng.random() < 0.6 else rng.choice(["div", "div", "section", "ul" if part == "nav" else "div"])
    tag = "td" if cell else tag
    if tag in ("div", "section", "ul", "td") and not attrs:
        attrs = _named(rng, part)
    link = lambda: f'<a href="/{_short(rng, 1)}">{_short(rng)}</a>'
    if part == "nav":
        inner = "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 9)))
        inner = inner if tag == "ul" else rng.choice([f"<ul>{inner}</ul>", " | ".join(link() for _ in range(4))])
    elif part == "comments":
        comment = lambda: f"<{rng.choice(['p', 'div', 'li'])}{rng.choice(['', _named(rng, 'comments')])}>{_sentences(rng, 3, 50)}</p>"
        inner = f"<h{rng.randint(2, 4)}>{_short(rng)}</h3>" + "".join(comment() for _ in range(rng.randint(1, 6)))
    elif part == "form":
        inner = f"<label>{_short(rng)}</label><input name=q><button>{_short(rng, 2)}</button>"
        if rng.random() < 0.4:
            inner = f"<p>{_sentences(rng, 4, 20)}</p>" + inner
        if rng.random() < 0.3:
            inner += "<select>" + "".join(f"<option>{_short(rng, 2)}" for _ in range(3)) + "</select>"
    elif part == "footer":
        inner = rng.choice(["&copy; ", "© 2024 ", "Copyright "]) + _short(rng) + " &middot; " + _sentences(rng, 3, 15)
        inner = rng.choice([inner, f"<p>{inner}</p>", f"<p>{inner}</p>" + "".join(link() for _ in range(4))])
    elif part == "aside":
        inner = f"<h3>{_short(rng)}</h3>" + rng.choice(
            [
                "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 6))) + "</ul>",
                "".join(f"<p>{_sentences(rng, 5, 40)}</p>" for _ in range(rng.randint(1, 3))),
            ]
        )
    elif part == "header":
        inner = rng.choice([_short(rng), f"<h1>{_short(rng)}</h1><p>{_short(rng, 8)}</p>", f"<p>{_sentences(rng, 4, 15)}</p>", link()])
    else:
        inner = rng.choice([_sentences(rng, 3, 40), f"<p>{_sentences(rng, 3, 40)}</p>", _short(rng) + link()])
    return f"<{tag}{attrs}>{inner}</{tag}>"


def _paragraph(rng):
    kind = rng.random()
    text = _sentences(rng, 1, 8) if rng.random() < 0.2 else _sentences(rng, 8, 120)
    if kind < 0.65:
        if rng.random() < 0.2:
            words = text.split(" ")
            k = rng.randrange(len(words))
            words[k] = rng.choice([f"<a href='/x'>{words[k]}</a>", f"<b>{words[k]}</b>", f"<em>{words[k]}</em>"])
            text = " ".join(words)
        return rng.choice([f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>", f"<div>{text}</div>"])
    if kind < 0.73:
        # Rows of a text table, as some articles hold.
        return f"<p>{' | '.join(_short(rng, 2) for _ in range(rng.randint(2, 20)))}</p>"
    if kind < 0.8:
        return f"<h{rng.randint(2, 4)}>{_short(rng, 7)}</h3>"
    if kind < 0.86:
        return "<ul>" + "".join(f"<li>{rng.choice([_short(rng, 6), _sentences(rng, 4, 25)])}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
    if kind < 0.9:
        return f"<blockquote>{rng.choice([text, f'<p>{text}</p>'])}</blockquote>"
    if kind < 0.94:
        return "<table>" + "".join(f"<tr><td>{_short(rng, 2)}</td><td>{rng.randint(1, 999)}</td></tr>" for _ in range(3)) + "</table>"
    if kind < 0.97:
        return f"<pre>{_short(rng, 9)}</pre>"
    return f"<figure><img src=x><figcaption>{_sentences(rng, 4, 15)}</figcaption></figure>"


def _opening(rng):
    """The start of a page; the ends of its head and the start of its body may be left out."""
    head = f"<head><title>{_short(rng)}</title><style>p{{}}</style>"
    if rng.random() < 0.8:
        return f"<!DOCTYPE html><html>{head}</head><body>"
    return rng.choice([f"<!DOCTYPE html><html>{head}", f"<html>{head}<body>", f"<title>{_short(rng)}</title>", "<html>", ""])


def _bare_page(rng):
    """A page that is little more than its text: no part has a name, and often there is no heading."""
    marked = [(_opening(rng), 0)]
    around = rng.choice([[], [], ["article"], ["main"], ["div"], ["div", "div"], ["center"], ["table", "tr", "td"]])
    marked += [(f"<{tag}>", 0) for tag in around]
    if rng.random() < 0.3:
        marked.append((f"<h1>{rng.choice([_short(rng, 9), _sentences(rng, 2, 12)])}</h1>", 1))
    if not around and rng.random() < 0.15:
        marked.append((_sentences(rng, 4, 60), 1))
    else:
        for _ in range(rng.choice([1, 1, 1, 2, 2, 3, 5, 8])):
            plain = rng.random() < 0.8
            marked.append((f"<p>{_sentences(rng, 6, 60)}</p>" if plain else _paragraph(rng), 1))
    marked += [(f"</{tag}>", 0) for tag in reversed(around)]
    if rng.random() < 0.25:
        marked.append((_part(rng, rng.choice(["footer", "nav", "comments"])), 0))
    return marked


def _table_page(rng):
    """A page laid out as a table: parts and main text are cells."""
    marked = [(_opening(rng) + "<table>", 0)]
    if rng.random() < 0.5:
        marked.append((f"<tr>{_part(rng, 'header', cell=True)}</tr>", 0))
    marked.append(("<tr>", 0))
    if rng.random() < 0.7:
        marked.append((_part(rng, rng.choice(["nav", "nav", "aside", "ad"]), cell=True), 0))
    marked.append((f"<td{rng.choice(['', ' width=600', f' class={rng.choice(_CONTENT)}'])}>", 0))
    if rng.random() < 0.7:
        marked.append((f"<h1>{_short(rng, 9)}</h1>", 1))
    marked += [(_paragraph(rng), 1) for _ in range(rng.choice([1, 2, 3, 5, 8]))]
    marked.append(("</td>", 0))
    if rng.random() < 0.4:
        marked.append((_part(rng, rng.choice(["aside", "ad"]), cell=True), 0))
    marked.append(("</tr>", 0))
    if rng.random() < 0.5:
        marked.append((f"<tr>{_part(rng, 'footer', cell=True)}</tr>", 0))
    marked.append(("</table>", 0))
    return marked


def labelled_page(rng):
    """A page and the labels of its blocks, in order."""
    kind = rng.random()
    if kind < BARE:
        return _bare_page(rng)
    if kind < BARE + TABLES:
        return _table_page(rng)
    marked = []  # pieces of the page, with 1 for main text

    def part(name):
        marked.append((_part(rng, name), 0))

    opened = []
    marked.append((_opening(rng), 0))
    if rng.random() < 0.4:
        opened.append("div")
        marked.append((f'<div class="{rng.choice(_NEUTRAL)}">', 0))
    before = [p for p in ("header", "nav", "notice", "ad", "form", "share", "aside") if rng.random() < 0.45]
    rng.shuffle(before)
    for name in before:
        part(name)
    if rng.random() < 0.3:
        marked.append((f"<main{rng.choice(['', ' role=main'])}>", 0))
        opened.append("main")
    style = rng.random()
    if style < 0.55:
        tag, attrs = "article", rng.choice(["", "", f' class="{rng.choice(_CONTENT)}"'])
    elif style < 0.9:
        tag, attrs = rng.choice(["div", "div", "section"]), rng.choice([' class="%s"', ' id="%s"']) % rng.choice(_CONTENT)
    else:
        tag, attrs = rng.choice(["div", "td", "main"]), ""
    marked.append((f"<{tag}{attrs}>", 0))
    if rng.random() < 0.8:
        marked.append((f"<h1>{rng.choice([_short(rng, 9), _sentences(rng, 2, 12)])}</h1>", 1))
    for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 13, 20])):
        marked.append((_paragraph(rng), 1))
        if rng.random() < 0.12:
            part(rng.choice(["ad", "ad", "aside", "share", "notice", "form"]))
    if rng.random() < 0.25:
        part(rng.choice(["share", "comments", "ad"]))
    marked.append((f"</{tag}>", 0))
    after = [p for p in ("comments", "aside", "share", "ad", "form", "nav", "notice") if rng.random() < 0.35]
    rng.shuffle(after)
    for name in after:
        part(name)
    for tag in reversed(opened):
        marked.append((f"</{tag}>", 0))
    if rng.random() < 0.8:
        part("footer")
    if rng.random() < 0.9:
        marked.append(("</body></html>", 0))
    return marked


def labelled_pages(n=PAGES, seed=SEED):
    """``(blocks, labels)`` of ``n`` pages laid out from templates.

    Labels are found by marking the pieces of main text with a character no text holds.
    """
    rng, mark = random.Random(seed), "\ue0ff"
    pages = []
    for _ in range(n):
        pieces = labelled_page(rng)
        page = "".join(re.sub(r"(?:>|\A)(?=[^<])", rf"\g<0>{mark}", piece) if main else piece for piece, main in pieces)
        found, labels = [], []
        for text, linked, above in blocks(page):
            clean = text.replace(mark, "").strip()
            if clean:
                found.append((clean, linked, above))
                labels.append(int(mark in text))
        pages.append((found, labels))
    return pages


def train():
    """The model of the registered query; the same on every run."""
    return fit(labelled_pages())


def main_text(page, field):
    """Blocks labelled as main text, joined by an empty line."""
    found = blocks(page, field.weights)
    if not found:
        return ""
    labels = field.decode(field.unary(Field.features(found)))
    return "\n\n".join(text for (text, _, _), label in zip(found, labels) if label)


def extracted(pages, field=None):
    """Main text of every page: ``(page_id, url, text, n_chars)``, a row per input row.

    Takes ``page_id``, ``url`` and ``html``; other columns are ignored. ``text`` is empty where
    no block is main text; ``n_chars`` counts its code points.

    * NULL and empty html, and pages without text, give an empty text.
    * Broken markup is read as far as it goes; nothing is cut off, however long.
    * Equal pages give equal texts. An empty table gives an empty result.
    """
    field = field or train()
    shared = pages.sparkSession.sparkContext.broadcast((field.weights, field.pairs, field.ends))

    def run(batches):
        model = Field(*shared.value)
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            for at in range(0, batch.num_rows, 256):
                texts = [main_text(h.as_py() or "", model) for h in column("html").slice(at, 256)]
                yield pa.RecordBatch.from_arrays(
                    [
                        column("page_id").slice(at, 256),
                        column("url").slice(at, 256),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
