"""HTML extraction (operator 7): a tree-structured graphical model over the DOM.

Block elements and the texts under them are the nodes; each is content or not. A node
has a potential for its features (tag, class words, length, link share) and an edge
has one for the states of parent and child. Sum-product messages go up the tree and
down again and give every text's marginal; texts over one half are the main text.
The potentials are counts over labelled pages: ``LABELLED_PAGES`` below, and a sample
of at most ``SAMPLE_PAGES`` of the given pages whose landmark elements label them. The
sample is parsed and counted by Spark; only the counts come to the driver.

Defined results: a null or empty page gives an empty text; a page without main text
too; a page of any length is read whole; markup cut off at the end of a page is dropped,
an open element ends with its parent, and an unclosed script, button or the like at the
next block; repeated rows give equal rows; a null page_id or url is passed on; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import ast
import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Pages of the table that are fitted on, those of the least hash; a fit needs no more.
SAMPLE_PAGES = 300
#: The weight of a page labelled by hand, and of the whole sample.
HAND_WEIGHT, SAMPLE_WEIGHT = 5.0, 10.0

# Elements of the HTML standard, by kind.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CODE = frozenset(["script", "style"])
RAW_TEXT = frozenset("textarea title iframe noembed noframes xmp noscript".split())
FOREIGN = frozenset(["svg", "math"])
HIDDEN = CODE | RAW_TEXT | FOREIGN | frozenset(["template", "select", "button"])
BLOCK = frozenset(
    "html body head address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol option p pre search section summary "
    "table tbody td tfoot th thead tr ul caption".split()
)
CLOSES_P = BLOCK - frozenset("html body head option tbody td tfoot th thead tr caption legend".split())
#: An element of the first kind ends an open one of the second, up to the third.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
#: Of these, the ones that say nothing of a list of plain text: one named menu may be of dishes.
LINK_WORDS = frozenset("breadcrumb breadcrumbs menu nav navbar navigation pagination toolbar topbar".split())
LISTS = frozenset("ul ol dl".split())
#: Elements that hold text itself. Their class words say how it looks, rarely what part of the page it is.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption".split())
#: Landmarks that label a page by themselves.
MAIN = frozenset(["article", "main"])
ASIDE = frozenset("nav header footer aside form menu dialog head".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer "
    "discussion header masthead menu modal nav navbar navigation newsletter notice pagination popup promo promoted recommended related "
    "replies respond share sharing sidebar social sponsor sponsored subscribe toolbar topbar widget".split()
)
CONTENT_WORDS = frozenset("article body content entry main page post story text".split())

_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    # a quote opens a value only after an equals sign
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)?)*+)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "names", "parent", "text", "links", "size")

    def __init__(self, tag: str, names: frozenset, parent: int):
        self.tag, self.names, self.parent = tag, names, parent
        self.text: str | None = None  # of a text node
        self.links = self.size = 0  # its characters, and those inside links; of an element, those of all its texts


def class_words(rest: str) -> frozenset:
    return frozenset(w.lower() for value in _NAMED.findall(rest) for w in _NAME_WORD.findall(value))


class Open:
    """The open elements, with the places of each tag's, so that an end tag finds its own at once."""

    def __init__(self):
        # tag, the block it is in, whether it ends at the next block, whether it is a block that is shown
        self.stack: list[tuple[str, int, bool, bool]] = [("page", 0, False, True)]
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.blocks = [0]
        self.loose: list[int] = []
        self.hidden = 0

    def push(self, tag: str, block: int, loose: bool = False) -> None:
        at = len(self.stack)
        shown = tag in BLOCK and not self.hidden
        self.stack.append((tag, block, loose, shown))
        self.places[tag].append(at)
        if shown:
            self.blocks.append(at)
        if loose:
            self.loose.append(at)
        self.hidden += tag in HIDDEN

    def pop(self) -> str:
        tag, _, loose, shown = self.stack.pop()
        self.places[tag].pop()
        if shown:
            self.blocks.pop()
        if loose:
            self.loose.pop()
        self.hidden -= tag in HIDDEN
        return tag

    def last(self, tags: Iterable[str]) -> int:
        return max((self.places[t][-1] for t in tags if self.places[t]), default=-1)


def _ending(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>|</{tag}\Z", re.I)


_ENDING = {tag: _ending(tag) for tag in HIDDEN}
_NEXT = {tag: re.compile(rf"<(/?){tag}(?=[\s/>]|\Z)", re.I) for tag in HIDDEN}


def parse(page: str) -> list[Node]:
    """Block elements and text blocks, each after its parent, in page order."""
    nodes = [Node("page", frozenset(), -1)]
    open_ = Open()
    stack = open_.stack
    run: list[str] = []
    linked = 0
    last_template = -1
    unended: set[str] = set()

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            own = Node("#text", frozenset(), stack[-1][1])
            own.text, own.size, own.links = text, len(text), min(linked, len(text))
            nodes.append(own)
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if open_.hidden:
            return
        text = html.unescape(raw)
        run.append(text)
        if open_.places["a"]:
            linked += len(text)

    def close(down_to: int) -> None:
        while len(stack) > down_to:
            if stack[-1][3]:
                flush()
            open_.pop()

    at, size = 0, len(page)
    while at < size:
        found = _MARKUP.search(page, at)
        if not found:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            if found[0].startswith("<![CDATA[") and any(open_.places[t] for t in FOREIGN):  # elsewhere it is a comment up to the next ">"
                ending = page.find("]]>", found.start())
                at = ending + 3 if ending >= 0 else at
            continue
        if found["end"]:
            if tag == "p" and not open_.places["p"] and not open_.hidden:
                flush()
            if open_.places[tag]:
                close(open_.places[tag][-1])
            continue
        rest = found["rest"]
        if tag in VOID:
            if tag == "hr" and not open_.hidden:
                flush()
            elif tag == "br" and not open_.hidden:
                run.append(" ")
            continue
        if tag in HIDDEN:
            loose = True
            if tag in CODE:
                ending = None if tag in unended else _ENDING[tag].search(page, at)
                if ending:
                    at = ending.end()
                    continue
                unended.add(tag)  # nor will a later one be
            elif tag in FOREIGN:
                if rest.endswith("/"):
                    continue
            elif tag == "template":
                if last_template < at:
                    last_template = max((m.start() for m in _ENDING[tag].finditer(page, at)), default=size + 1)
                loose = last_template > size
            else:  # these do not nest: another one first means that this one was not closed
                following = _NEXT[tag].search(page, at)
                loose = not (following and following[1])
                if not loose and tag in RAW_TEXT:
                    ending = page.find(">", following.end())
                    at = ending + 1 if ending >= 0 else size
                    continue
            open_.push(tag, stack[-1][1], loose)
            continue
        if tag in BLOCK and tag != "option":
            while open_.loose and open_.loose[-1] > open_.blocks[-1]:
                close(open_.loose[-1])
        if tag in CLOSES_P and stack[open_.blocks[-1]][0] == "p":
            close(open_.blocks[-1])
        if tag in IMPLIED_END:
            ended, until = IMPLIED_END[tag]
            place = open_.last(ended)
            if place > open_.last(until):
                close(place)
        block = stack[-1][1]
        if tag in BLOCK and not open_.hidden:
            flush()
            open_.push(tag, len(nodes))
            nodes.append(Node(tag, class_words(rest), block))
        else:
            open_.push(tag, block)
    close(1)
    flush()
    for node in reversed(nodes[1:]):
        above = nodes[node.parent]
        above.size, above.links = above.size + node.size, above.links + node.links
    return nodes


def features(nodes: list[Node], i: int) -> list[str]:
    node = nodes[i]
    if node.text is None:
        aside, content = sorted(node.names & ASIDE_WORDS), sorted(node.names & CONTENT_WORDS)
        if node.tag in TEXTUAL:
            return [f"tag {node.tag}"]
        if node.tag in LISTS and 2 * node.links < node.size:
            aside = [w for w in aside if w not in LINK_WORDS]
        words = [f"word {w}" for w in aside + content]
        return [f"tag {node.tag}", *words, *["named aside"] * bool(aside), *["named content"] * bool(content)]
    length = min(6, int(math.log2(1 + len(node.text.split()))))
    linked = round(4 * node.links / len(node.text))
    return [f"text {length}", f"links {linked}"]


def landmark_states(nodes: list[Node]) -> list[int | None] | None:
    """The states that landmark elements give a page, or None without any; None where class words put them in doubt."""
    if not any(n.tag in MAIN for n in nodes):
        return None
    states: list[int | None] = [0] * len(nodes)
    for i, node in enumerate(nodes[1:], 1):
        above = states[node.parent]
        if node.tag in ASIDE:
            states[i] = 0
        elif above is None or (above == 1 or node.tag in MAIN) and node.names & ASIDE_WORDS:
            states[i] = None
        else:
            states[i] = int(node.tag in MAIN or above == 1)
    return states


# Labelled pages: the texts that are content are marked with a leading "+".
LABELLED_PAGES = (
    '<body><header class="masthead"><p>Site</p><nav><ul><li><a>Home</a></li><li><a>News</a></li></ul></nav></header>'
    '<div class="content"><h1>+Title of it</h1><p>+The first paragraph of the article has quite a few words in it, as they do.</p>'
    "<p>+Short one.</p><ul><li>+A point made</li><li>+Another point</li></ul><blockquote><p>+Words that somebody said once.</p></blockquote>"
    '<div class="share"><a>Share</a></div></div><aside class="sidebar"><h3>Related</h3><ul><li><a>Other story</a></li></ul></aside>'
    '<section class="comments"><h2>Comments</h2><div class="comment"><p>I do not agree with this at all, to be honest with you.</p></div></section>'
    "<footer><p>All rights reserved</p></footer></body>",
    '<body><div class="cookie-notice"><p>We use cookies to make this site work.</p><form><input></form></div><div id="nav"><a>One</a> <a>Two</a></div>'
    '<main><div><h2>+Heading</h2><p>+Some words of the text that a reader came here for, and then some more.</p><div class="ad">Buy this now</div>'
    "<p>+And the end of the text.</p><table><tr><td>+A cell</td><td>+12</td></tr></table></div></main>"
    '<div class="newsletter"><form><p>Subscribe to our letter</p></form></div><div id="footer"><p>Contact us</p></div></body>',
    '<body><div class="topbar"><ul><li><a>A</a></li></ul></div><div><div><h1>+Name</h1><p>+Words and words and words in a plain paragraph without any landmark.</p>'
    "<p>+More of them follow here.</p><pre>+code of it</pre></div></div>"
    '<div class="related"><ul><li><a>Story</a></li><li><a>Story two</a></li></ul></div><div class="popup modal"><p>Sign up today</p></div></body>',
    '<body><nav class="breadcrumb"><a>Home</a> / <a>Here</a></nav><article><header><h1>+Headline here</h1></header><section><p>+A text in a section of an article with enough words.</p>'
    '<figure><figcaption>+A caption</figcaption></figure></section><div class="advert"><p>Advertisement text which runs on for a while, as such texts do.</p></div>'
    '<form><p>Search</p></form><div class="comments"><p>Reader says something</p></div><p>+Last words.</p><dl><dt>+Term</dt><dd>+Meaning</dd></dl></article>'
    '<dialog><p>Please accept</p></dialog><menu><li><a>Menu</a></li></menu><div class="sponsored promo"><p>Promoted words from a partner of ours</p></div></body>',
    '<body><header><a>Logo</a></header><section class="content post"><h2>+What to bring</h2><ul><li>+Boots</li><li>+A map of the whole place</li><li>+Bread</li></ul>'
    "<h3>+How to get there</h3><ol><li>+Take the train to the last stop.</li><li>+Walk.</li></ol><p>+That is all.</p></section>"
    '<section id="comments"><ul><li><p>Nice</p></li></ul></section><footer><nav><ul><li><a>About</a></li></ul></nav></footer></body>',
    '<body><article class="post share-count"><h1>+A post that people share</h1><p>+It has a paragraph of a good many words, as an article is wont to have.</p>'
    '<div class="related-work"><h2>+Related work</h2><p>+Others have written on this before, and what they found is told here at some length.</p></div>'
    '<ul class="social share"><li><a>Share this</a></li><li><a>Send</a></li></ul></article>'
    '<div class="comment-list"><div class="comment reply"><p>Thank you for this, I had been looking for it for a long time.</p></div>'
    '<div class="comment"><p>It did not work for me, and I do not know why that is.</p><p>But I will try it again.</p></div></div></body>',
    '<body><div class="menu"><a>Start</a><a>Shop</a></div><div id="page"><div class="entry text"><h1>+The menu of a banner year</h1><p>+What they ate and what they drank, in so many words, day after day.</p></div>'
    '<div class="sidebar widget"><p>Written by somebody who likes to write about what is eaten.</p><ul><li><a>Older</a></li></ul></div>'
    '<div class="banner">A word from those who pay for this</div><div class="disclaimer"><p>Nothing here is advice, and nobody answers for what comes of it.</p></div>'
    '<div class="subscribe"><p>Leave us your address and we will write to you every week.</p></div><div class="pagination"><a>1</a><a>2</a></div></div></body>',
    '<body><div class="story"><p>+A first paragraph without a heading, which goes on for quite a while.</p><p>+Then a second.</p><p>+And a third one of some length to end it.</p></div>'
    '<section class="respond replies"><h3>Replies</h3><article class="comment"><p>A reader of this page wrote these words under it, and quite a few of them too.</p></article>'
    '<article class="comment"><p>Another reader did not like what the first one had to say.</p></article></section>'
    '<div class="consent cookies"><p>This site stores small files on your device to remember what you like.</p></div><p>Copyright</p></body>',
    '<body><article><h1>+A wet day</h1><p>+It rained.</p><div class="advert"><p>Buy a coat</p></div><p>+All day.</p><p>+So we stayed.</p><form><p>Find</p></form><p>+Then it was dry.</p><p>+The end.</p></article></body>',
    '<body><nav class="menu"><ul><li><a>Start</a></li><li><a>Where we are</a></li></ul></nav><article class="post"><h1>+A place to eat</h1><p class="ad-free">+They cook what the sea gives them, and they do it well.</p>'
    '<ul class="menu"><li>+Soup of beans and cabbage</li><li>+Bream with fennel</li><li>+Pears in red wine</li></ul><p class="notice">+Note that they are closed on Mondays.</p>'
    '<p class="header-note social-history">+The house was a school for a hundred years.</p></article>'
    '<div class="discussion"><div class="entry"><p>I went there last week and had to wait for an hour.</p></div><div class="entry"><p>We did not, and we liked it a lot.</p></div></div></body>',
)

def marked_states(nodes: list[Node]) -> list[int]:
    """The states of a page whose content texts start with "+": of elements, whether most of their texts are content."""
    votes = [0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        if nodes[i].text is not None:
            votes[i] = 1 if nodes[i].text.startswith("+") else -1
        if i:
            votes[nodes[i].parent] += votes[i]
    return [int(v > 0) for v in votes]


class TreeModel:
    """Log potentials out of counts: (state, feature) and (child is a text, state of the parent, state)."""

    def __init__(self):
        self.counts: Counter = Counter({(text, a, b): 0.9 if a == b else 0.1 for text in (False, True) for a in (0, 1) for b in (0, 1)})

    def learn(self, counts: Counter, weight: float = 1.0) -> None:
        for key, n in counts.items():
            self.counts[key] += weight * n

    def ready(self) -> TreeModel:
        count, smooth = self.counts, 0.5
        self.log_edge = [[[math.log(count[text, a, b] / (count[text, a, 0] + count[text, a, 1])) for b in (0, 1)] for a in (0, 1)] for text in (False, True)]
        kind = lambda f: {"word": "tag", "named": "tag"}.get(f.split()[0], f.split()[0])  # noqa: E731  every element has one tag
        total: Counter = Counter()
        for key, n in count.items():
            if len(key) == 2 and key[1].split()[0] not in ("word", "named"):
                total[key[0], kind(key[1])] += n
        self.log_feature = {
            f: tuple(math.log((count[s, f] + smooth) / (total[s, kind(f)] + smooth * 20)) for s in (0, 1)) for f in {k[1] for k in count if len(k) == 2}
        }
        return self

    def unary(self, nodes: list[Node], i: int) -> tuple[float, float]:
        found = [self.log_feature.get(f, (0.0, 0.0)) for f in features(nodes, i)]
        return sum(a for a, _ in found), sum(b for _, b in found)

    def marginals(self, nodes: list[Node]) -> list[float]:
        """P(content) of each node by one upward and one downward pass of messages."""
        own = [list(self.unary(nodes, i)) for i in range(len(nodes))]
        up: list[tuple[float, float]] = [(0.0, 0.0)] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):  # children come after their parents
            edge = self.log_edge[nodes[i].text is not None]
            up[i] = tuple(_log_sum(own[i][0] + edge[a][0], own[i][1] + edge[a][1]) for a in (0, 1))
            parent = own[nodes[i].parent]
            parent[0] += up[i][0]
            parent[1] += up[i][1]
        belief = own  # of the subtree; becomes that of the whole tree on the way down
        out = [0.0] * len(nodes)
        for i in range(len(nodes)):
            if i:
                above = belief[nodes[i].parent]
                rest = above[0] - up[i][0], above[1] - up[i][1]
                edge = self.log_edge[nodes[i].text is not None]
                for s in (0, 1):
                    belief[i][s] += _log_sum(rest[0] + edge[0][s], rest[1] + edge[1][s])
            out[i] = 1 / (1 + math.exp(min(700.0, belief[i][0] - belief[i][1])))
        return out


def _log_sum(a: float, b: float) -> float:
    high = max(a, b)
    return high + math.log1p(math.exp(min(a, b) - high))


def main_text(page: str, model: TreeModel) -> str:
    nodes = parse(page)
    chance = model.marginals(nodes)
    return "\n".join(n.text for n, p in zip(nodes, chance) if n.text is not None and p > 0.5)


def page_counts(nodes: list[Node], states: list[int | None], edges: bool = True) -> Counter:
    """What a labelled page adds to the counts of a model; nodes in doubt add nothing.

    Landmarks leave out what is no content inside an article, so edges are counted on pages labelled by hand only.
    """
    counts: Counter = Counter()
    for i, state in enumerate(states):
        if state is not None:
            counts.update((state, f) for f in features(nodes, i))
            if edges and i:
                counts[nodes[i].text is not None, states[nodes[i].parent], state] += 1
    return counts


def fit(pages: Iterable[str] = ()) -> TreeModel:
    """Fits on the pages labelled here and on pages with landmarks."""
    found = [page_counts(nodes, states, False) for nodes in map(parse, pages) if (states := landmark_states(nodes))]
    return _fitted(sum(found, Counter()), len(found))


def _fitted(sample: Counter, n: int) -> TreeModel:
    model = TreeModel()
    model.learn(Counter((0, f"word {w}") for w in ASIDE_WORDS), HAND_WEIGHT)  # each once in a block that is no content
    for page in LABELLED_PAGES:
        nodes = parse(page)
        model.learn(page_counts(nodes, marked_states(nodes)), HAND_WEIGHT)
    if n:
        model.learn(sample, SAMPLE_WEIGHT / n)
    return model.ready()


def fit_on(pages: DataFrame) -> TreeModel:
    """Fits on the pages labelled here and on SAMPLE_PAGES different pages at most, those of the least hash."""
    rows = pages.select(F.col("html").cast("string").alias("html")).where("html <> ''").withColumn("h", F.xxhash64("html"))
    n = max(1, rows.agg(F.approx_count_distinct("h", 0.02)).first()[0])
    share = min(1.0, 4 * SAMPLE_PAGES / n)  # hashes over it are not among the least
    low = int(-(1 << 63) + share * ((1 << 64) - 1))
    kept = rows.where(F.col("h") <= min(low, (1 << 63) - 1))
    chosen = [r.h for r in kept.select("h").distinct().orderBy("h").limit(SAMPLE_PAGES).collect()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for page in batch["html"].to_pylist():
                nodes = parse(page)
                states = landmark_states(nodes)
                if states:
                    counts.update({("pages",): 1, **page_counts(nodes, states, False)})
            keys = pa.array([repr(k) for k in counts], pa.string())
            yield pa.RecordBatch.from_arrays([keys, pa.array(counts.values(), pa.int64())], ["key", "n"])

    counted = kept.where(F.col("h").isin(chosen)).dropDuplicates(["h"]).select("html").mapInArrow(count, "key string, n long")
    # as many rows as there are features
    sample = Counter({ast.literal_eval(r.key): r.n for r in counted.groupBy("key").agg(F.sum("n").alias("n")).collect()})
    return _fitted(sample, sample.pop(("pages",), 0))


def extract(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for every row."""
    model = model or fit_on(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                texts = [main_text(page, model) for page in part["html"].to_pylist()]
                columns = [part["page_id"], part["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
