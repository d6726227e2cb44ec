"""Main text of web pages by a tree-structured graphical model.

The nodes of the model are the block elements of a page and the runs of text inside them. Each node is
main content or not. Potentials tie a node to its parent and to what can be seen of it (tag, words
of its class and id, amount of text, share of links). They are trained by maximum likelihood on labelled
pages, whose gradient needs the same marginals that extraction uses. Sum-product messages go up and down the tree; a run of text is taken if its marginal favours content.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.llm.store import pick

#: Elements that do not begin a block of their own. Fixed by HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd map mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br".split()
)
#: Elements without content and without an end tag. Fixed by HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page. Fixed by HTML.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: What a start tag ends: an open paragraph, or an open element of the same list or table. Fixed by HTML.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
SAME = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|</?[a-zA-Z][^>]*\Z",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+))""")
WORD = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Node:
    """A block element, or a run of text (tag `#text`)."""

    tag: str
    parent: int
    words: tuple[str, ...] = ()
    text: str = ""
    chars: int = 0
    link_chars: int = 0
    main: str | None = None  # of labelled pages: "1" or "0" from here down


class _Stack:
    """The open elements, with the places of each tag, so that none has to be searched for.

    An inline element that ends before those inside it keeps its place, without a tag.
    """

    def __init__(self) -> None:
        self.tags: list[str | None] = []
        self.nodes: list[int] = []  # the block an element is or stands in
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []  # places of elements that are no inline ones
        self.links: Counter[int] = Counter()  # open links by block
        self.push("#page", 0)

    def push(self, tag: str, node: int) -> None:
        self.places[tag].append(len(self.tags))
        if tag not in INLINE:
            self.blocks.append(len(self.tags))
        if tag == "a":
            self.links[node] += 1
        self.tags.append(tag)
        self.nodes.append(node)

    def last(self, *tags: str) -> int:
        """The place of the nearest open element of these, -1 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places[t]), default=-1)

    def end(self, place: int) -> None:
        """Ends the element at this place, the nearest of its tag, alone."""
        tag = self.tags[place]
        self.places[tag].pop()
        if tag == "a":
            self.links[self.nodes[place]] -= 1
        self.tags[place] = None

    def cut(self, place: int) -> None:
        """Ends the element at this place and all inside it."""
        while len(self.tags) > place:
            if self.tags[-1] is not None:
                self.end(len(self.tags) - 1)
            self.tags.pop()
            self.nodes.pop()
        while self.blocks and self.blocks[-1] >= place:
            self.blocks.pop()


def parse(page: str) -> list[Node]:
    """The nodes of a page in page order, parents first. Unclosed, misplaced and cut-off markup is tolerated."""
    nodes = [Node("#page", -1)]
    stack = _Stack()
    run: list[str] = []
    linked = 0

    def end_run() -> None:
        nonlocal linked
        text = " ".join("".join(run).split())
        if text:
            nodes.append(Node("#text", stack.nodes[-1], text=text, chars=len(text), link_chars=min(linked, len(text))))
        run.clear()
        linked = 0

    def say(data: str) -> None:
        nonlocal linked
        if data:
            data = entities.unescape(data)
            run.append(data)
            if stack.links[stack.nodes[-1]]:
                linked += len(data.strip())

    def close(tags: tuple[str, ...], until: tuple[str, ...]) -> None:
        """Ends the nearest open element of these, if none of `until` stands between."""
        place = stack.last(*tags)
        if place > 0 and place >= stack.last(*until):
            end_run()
            stack.cut(place)

    at = 0
    while at < len(page):
        found = MARKUP.search(page, at)
        say(page[at : found.start()] if found else page[at:])
        if not found:
            break
        at = found.end()
        slash, tag, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            if found[0].startswith("<![CDATA["):
                run.append(found[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if slash:
            if tag in INLINE:
                place = stack.last(tag)
                if place > stack.blocks[-1]:
                    stack.end(place)
            else:
                close((tag,), ())
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            at = end.start() if end else len(page)
            if end is None:
                break
            continue
        if tag == "br":
            run.append(" ")
        if tag in INLINE:
            if tag not in VOID:
                stack.push(tag, stack.nodes[-1])
            continue
        end_run()
        if tag in ENDS_P:
            close(("p",), ("button", "table", "td", "th", "li"))
        if tag in SAME:
            for _ in range(2):
                close(*SAME[tag])
        seen, main = (), None
        if "=" in rest:
            attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)}
            named = WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower())
            role = WORD.findall(attributes.get("role", "").lower())
            seen = tuple(sorted({f"word {w[:6]}" for w in named} | {f"role {w}" for w in role}))
            main = attributes.get("data-main")
        nodes.append(Node(tag, stack.nodes[-1], seen, main=main))
        if tag not in VOID and not rest.rstrip().endswith("/"):
            stack.push(tag, len(nodes) - 1)
    end_run()
    for node in reversed(nodes):
        if node.parent >= 0:
            nodes[node.parent].chars += node.chars
            nodes[node.parent].link_chars += node.link_chars
    return nodes


def features(node: Node) -> Iterator[str]:
    """What can be seen of a node."""
    kind = "run" if node.tag == "#text" else "block"
    yield f"{kind} chars {min(node.chars.bit_length(), 10)}"
    share = node.link_chars / node.chars if node.chars else 0
    yield f"{kind} links {0 if share < 0.1 else 1 if share < 0.5 else 2}"
    if node.tag == "#text":
        yield f"run ends {'.!?'.find(node.text[-1]) >= 0}"
        yield f"run sign {node.text[0] in '©®|·»›'}"
    else:
        yield f"tag {node.tag}"
        yield from node.words


def soft(x: float) -> float:
    """log(1 + exp(x))"""
    return x + math.log1p(math.exp(-x)) if x > 0 else math.log1p(math.exp(x))


def odds_to_share(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def pass_messages(parents: list[int], under: tuple[list[float], list[float]]) -> tuple[list[float], list[tuple[float, float]]]:
    """Sum-product over a tree whose parents come first.

    under[x][k] is the log-potential of node k being content when its parent's label is x. Gives the marginal
    of each node, and the joint ones of it being content with its parent not, and with its parent being so.
    """
    n = len(parents)
    below = [0.0] * n  # what the children say in favour of content
    for k in range(n - 1, 0, -1):
        below[parents[k]] += soft(under[1][k] + below[k]) - soft(under[0][k] + below[k])
    marginal, joint = [0.0] * n, [(0.0, 0.0)] * n
    for k in range(n):
        above = marginal[parents[k]] if k else 0.0
        joint[k] = tuple(s * odds_to_share(u[k] + below[k]) for s, u in zip((1 - above, above), under))
        marginal[k] = sum(joint[k])
    return marginal, joint


@dataclass
class Model:
    """Of each feature the log-potentials of content under a parent that is none, and under one that is."""

    weights: dict[str, tuple[float, float]]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """The probability of content for each node."""
        known = [[self.weights.get(f, (0.0, 0.0)) for f in features(n)] for n in nodes]
        under = [sum(w[0] for w in ws) for ws in known], [sum(w[1] for w in ws) for ws in known]
        return pass_messages([n.parent for n in nodes], under)[0]

    def main_text(self, page: str | None) -> str:
        """The runs of content, one a line."""
        nodes = parse(page or "")
        return "\n".join(n.text for n, x in zip(nodes, self.marginals(nodes)) if n.tag == "#text" and x > 0.5)


def labels(nodes: list[Node]) -> list[bool]:
    """Labels of a page that marks its main content by data-main attributes."""
    out = []
    for node in nodes:
        inherited = out[node.parent] if node.parent >= 0 else False
        out.append(inherited if node.main is None else node.main == "1")
    return out


def train(pages: Iterable[str], rounds: int = 30, rate: float = 0.3, hidden: float = 0.2, seed: int = 7) -> Model:
    """Potentials of greatest likelihood on labelled pages, by adaptive gradient steps.

    In every round a share of all features is hidden, so that none is relied on alone.
    """
    place: dict[str, int] = {}
    shown: list[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]] = []
    for page in pages:
        nodes = parse(page)
        marked = np.array(labels(nodes), float)
        parents = [n.parent for n in nodes]
        pairs = [(k, place.setdefault(f, len(place))) for k, n in enumerate(nodes) for f in features(n)]
        above = np.concatenate([[0.0], marked[parents[1:]]]) if len(nodes) > 1 else np.zeros(1)
        wanted = np.stack([marked * (1 - above), marked * above])
        shown.append((parents, *np.array(pairs, np.int64).T, wanted))
    rng = np.random.default_rng(seed)
    weights, steps = np.zeros((2, len(place))), np.full((2, len(place)), 1e-3)
    for _ in range(rounds):
        for k in rng.permutation(len(shown)):
            parents, at, feature, wanted = shown[k]
            kept = rng.random(len(at)) >= hidden
            at, feature = at[kept], feature[kept]
            under = [np.bincount(at, w[feature], len(parents)).tolist() for w in weights]
            gap = wanted - np.array(pass_messages(parents, under)[1]).T
            for w, step, g in zip(weights, steps, gap):
                slope = np.bincount(feature, g[at], len(place)) - 1e-3 * w
                step += slope * slope
                w += rate * slope / np.sqrt(step)
    return Model({f: (float(weights[0, k]), float(weights[1, k])) for f, k in place.items()})


#: Labelled layouts: data-main="1" marks main content, "0" what is none inside of it. In braces stand texts
#: that are filled in: title, long and short paragraphs, links and words.
MAIN_PART = "<h1>{title}</h1><p>{long}</p><p>{long}</p><h2>{title}</h2><p>{short}</p><p>{long}</p>"
TALK = '<div class="comment"><p>{long}</p><a href="#">{word}</a></div><div class="comment reply"><p>{short}</p></div>'
LAYOUTS = (
    "<html><head><meta charset=utf-8><title>{title}</title></head><body><header><h1>{word}</h1><p>{short}</p></header>"
    "<nav><ul>{items}</ul></nav><main data-main=1>" + MAIN_PART + "<ul><li>{short}</li><li>{short}</li></ul></main>"
    "<aside><h3>{word}</h3><p>{short}</p><ul>{items}</ul></aside><footer><p>&copy; {short}</p></footer></body></html>",
    '<html><body><div id="header" class="site-header top"><a href="/">{word}</a></div><div class="menu navbar navigation"><ul>{items}</ul></div>'
    '<div id="content" class="content post entry story" data-main=1>' + MAIN_PART + "<blockquote><p>{long}</p></blockquote></div>"
    '<div id="sidebar" class="sidebar widget"><h3>{word}</h3><p>{short}</p>{links}</div><div id="footer" class="site-footer bottom copyright">{short}</div></body></html>',
    '<html><body><div class="cookie cookies notice consent banner" role="alert"><p>{long}</p><button>{word}</button></div>'
    "<article data-main=1>" + MAIN_PART + '<section class="comments discussion" id="comments" data-main=0><h2>{word}</h2>' + TALK + "</section></article>"
    '<form><label>{word}</label><input name=q><textarea>x</textarea><button>{word}</button></form><footer>{links}</footer></body></html>',
    '<html><body><header class="page-header masthead"><nav class="breadcrumb breadcrumbs">{links}</nav></header><div class="container wrapper page">'
    '<div class="row"><div class="main article body text" data-main=1>' + MAIN_PART + '<div class="ad ads advert advertisement sponsored promo" data-main=0>{long}</div>'
    "<p>{long}</p><figure><figcaption>{short}</figcaption></figure></div>"
    '<aside class="related recommended"><h4>{word}</h4><ul>{items}</ul></aside></div></div><div class="popup modal newsletter subscribe"><p>{long}</p>'
    "<form><p>{short}</p><input><button>{word}</button></form></div></body></html>",
    '<html><body><div class="alert warning message notice"><p>{short}</p></div><section class="article post" data-main=1>' + MAIN_PART
    + '<div class="share social toolbar" data-main=0>{links}</div><aside class="pullquote sidebar" data-main=0><p>{short}</p></aside><p>{long}</p></section>'
    '<ol class="commentlist thread replies"><li class="comment"><p>{long}</p></li><li class="comment"><p>{short}</p></li></ol>'
    '<div class="search login signup"><form><p>{short}</p><input></form></div><noscript>{short}</noscript></body></html>',
    '<html><body><table class="nav"><tr><td>{links}</td></tr></table><div role="main" data-main=1>' + MAIN_PART
    + "<table><tr><th>{word}</th><td>{short}</td></tr></table><pre>{long}</pre></div>"
    '<div class="pagination pager tags">{links}</div><div role="contentinfo" class="legal disclaimer terms"><p>{long}</p></div>'
    '<div role="navigation">{links}</div><div role="complementary"><p>{short}</p></div><div role="banner"><p>{short}</p></div></body></html>',
    "<html><body><article data-main=1>" + MAIN_PART + '<form data-main=0><p>{short}</p><label>{word}</label><select><option>{word}</option></select></form>'
    '<div class="ad" data-main=0><p>{short}</p></div><nav data-main=0>{links}</nav><footer data-main=0><p>{short}</p></footer></article>'
    '<div class="ad">{short}</div><div class="reviews feedback"><p>{long}</p></div></body></html>',
    '<html><body><div id="wrap"><div class="topbar header"><a href="/">{word}</a></div><div class="post-content" data-main=1>' + MAIN_PART
    + '</div><div class="comments-area"><h3>{word}</h3><p>{long}</p><p>{long}</p></div><div class="cookie-bar"><p>{long}</p></div></div></body></html>',
    "<html><body data-main=1>" + MAIN_PART + "</body></html>",
    '<html><body data-main=1><div class="nav menu" data-main=0>{links}</div>' + MAIN_PART + '<div class="footer" data-main=0><p>{short}</p></div></body></html>',
    "<div data-main=1><p>{long}</p><p>{short}</p></div>",
)
#: Fills of each layout, given pages of the sample, and characters of one of these at most.
FILLS = 30
SAMPLE = 200
SAMPLE_CHARS = 60_000
WORDS = "A plain line of words, for pages when no other text is at hand."


def filled(layout: str, lines: list[str], rng: random.Random) -> str:
    """The layout with texts drawn from these lines."""

    def words(low: int, high: int) -> str:
        out: list[str] = []
        n = rng.randint(low, high)
        while len(out) < n:
            out += rng.choice(lines).split() or ["x"]
        return entities.escape(" ".join(out[:n]))

    def put(match: re.Match) -> str:
        name = match[1]
        if name in ("items", "links"):
            links = [f'<a href="/{k}">{words(1, 2)}</a>' for k in range(rng.randint(3, 8))]
            return "".join(f"<li>{x}</li>" for x in links) if name == "items" else " ".join(links)
        low, high = {"title": (3, 9), "long": (8, 120), "short": (1, 14), "word": (1, 2)}[name]
        return words(low, high) + ("." if name in ("long", "short") else "")

    return re.sub(r"\{(\w+)\}", put, layout)


def labelled(page: str) -> str | None:
    """The page with the label that its own markup gives: one article element, whose parts for other uses are none."""
    if len(re.findall(r"<article[\s>]", page, re.IGNORECASE)) != 1:
        return None
    page = re.sub(r"<article(?=[\s>])", '<article data-main="1"', page, flags=re.IGNORECASE)
    return re.sub(r"<(nav|aside|footer|header|form)(?=[\s>])", r'<\1 data-main="0"', page, flags=re.IGNORECASE)


def fit(pages: DataFrame, html: str = "html", seed: int = 7) -> Model:
    """A model trained on at most SAMPLE of the given pages that label themselves, and on the filled layouts."""
    rows = pick(pages, html=html).where(F.length("html") <= SAMPLE_CHARS).withColumn("hash", F.xxhash64("html"))
    first = rows.select("hash").distinct().orderBy("hash").limit(SAMPLE)  # hashes travel, not pages
    last = first.agg(F.max("hash")).first()[0]
    some = rows.where(F.col("hash") <= F.lit(last)).groupBy("hash").agg(F.min("html").alias("html")).orderBy("hash").collect()
    own = [page for row in some if (page := labelled(row["html"]))]
    lines = []
    for nodes in map(parse, own):
        lines += [node.text for node, main in zip(nodes, labels(nodes)) if main and node.text]
    lines, rng = lines or [WORDS], random.Random(seed)
    return train(own + [filled(layout, lines, rng) for layout in LAYOUTS for _ in range(FILLS)])


def extract(pages: DataFrame, model: Model, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for each row: the main text of the whole page, one block a line.

    Null, empty and unreadable pages give an empty text. Repeated rows and null ids stay; other columns
    are not looked at.
    """
    rows = pick(pages, page_id=page_id, url=url, html=html)
    schema = T.StructType(
        [rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.main_text(x.as_py()) for x in batch.column("html")]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)
