"""Main text of HTML pages by tag-path ratios.

A page is read into blocks of text, each with its root-to-leaf path of block-level tags and their
classes. Elements that the markup itself sets apart (menus, headers, footers, sidebars, forms, what
is hidden) are no candidates. For every path the length of text and the number of punctuation marks
per block are taken, smoothed over neighbouring blocks of one container, and fused into one score with
three votes: the share of text that is no link, whether words of class or id speak of frame, and
whether the page has an article or main element that the path is not in. Paths whose score reaches a
share of the page's mean are content paths.

A word of class or id is a vote where it cannot name a chapter or product (inside an article or
main: wherever no other words stand beside it), or most of its element's text is links; a section
whose id is such a word alone must also be the last. Headings and paragraphs have no such votes.
The main text is the blocks on content paths, and with them those that share their container (an
article or main element as a whole) and have no vote against them, unless they are nothing but
links; a heading goes with the block that it stands over.

Defined results: null or empty html, or html without text, gives an empty text; markup that is
cut short or badly nested is read as far as it goes; character references that are none stay as
they are. Pages are handled one by one, so repeated rows get equal results and an empty table an
empty one. Each page must fit into a task.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tristrata.llm.arrowtext import pieces

#: A path is content when its score is at least this share of the weighted mean score.
SCORE_SHARE = 0.25
#: Weights of the block itself and its neighbours on either side.
SMOOTH = (0.25, 0.5, 0.25)
LINKS_ONLY = 0.9
#: What a word of class or id leaves of a path's score, and what a place outside the page's article.
WORD_VOTE = 0.05
PLACE_VOTE = 0.2
#: What a class or id may take for frame is frame when this share of its text is links.
LINKS_MOST = 0.5

TOKEN = re.compile(
    r"<!--.*?(?:-->|$(?![\s\S]))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/<>]*)(?P<attrs>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+)>"
    r"|</?[a-zA-Z!?][^<>]*>"
    r"|<[!?/][^<>]*>"
    r"|<[a-zA-Z/!?][^<>]*$(?![\s\S])",
    re.S,
)
ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'<>]+))?")
UNQUOTED = re.compile(r"=\s*[^\s\"'=]+$")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")

# Element kinds of the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header html legend li main menu nav ol"
    " option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
BREAKS = frozenset(["br", "hr"])
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: A start tag closes an open element of these kinds, up to the elements that bound them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# What is not the article, by element, role, or a word of class or id.
NOT_CONTENT = frozenset(
    "head nav header footer aside form button select dialog menu template svg canvas object"
    " audio video fieldset".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu"
    " menubar toolbar".split()
)
WORDS = frozenset(
    "ad ads adsense alert banner breadcrumb breadcrumbs consent disclaimer discussion disqus"
    " footer gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice"
    " notices notification outbrain overlay pager pagination popup promo promoted promotion"
    " recommended related replies reply respond reviews search share sharing sidebar signup social"
    " subscribe taboola toolbar topbar widget widgets".split()
)
STEMS = ("advert", "comment", "cookie", "sponsor", "sidebar", "subscri", "newsletter", "breadcrumb")
#: Words with which a class speaks of the frame around the content.
FRAME = frozenset(
    "article body container content entry has layout main no page post site with without wrap"
    " wrapper".split()
)
#: Words that also name chapters; by themselves they mark nothing inside an article or main.
UNSURE = frozenset(
    "alert banner consent disclaimer discussion footer header hidden login menu modal navigation"
    " notice notices notification overlay pagination promotion recommended related replies reply"
    " respond reviews search share sharing signup social toolbar".split()
)
#: Words that leave the meaning of a mark as it is.
PLAIN = frozenset(
    "area bar block bottom box button buttons form google icons info inline inner item items js law"
    " left link links list middle nav outer panel post posts right section side slot text thread"
    " title top unit wp".split()
)
#: What a class or id says: nothing; frame if mostly links; so, or if no article text follows; frame.
NONE, LINKED, LAST, FRAMED = range(4)
#: Headings and paragraphs are text, whatever their class or id.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXT_TAGS = HEADINGS | {"p"}
FRAME_TAGS = frozenset(["html", "body", "main", "article"])
#: Elements that hold content together, and those that do so whatever is inside them.
CONTAINERS = FRAME_TAGS | {"div", "center"}
WHOLE = frozenset(["main", "article"])
PAGE = frozenset(["html", "body"])

Owner = tuple[int, int, str]
Block = tuple[str, str, int, float]


def named_otherwise(name: str, attrs: str) -> bool:
    """Whether a start tag says by itself that its element is not part of the article."""
    if name in NOT_CONTENT:
        return True
    if not attrs.strip() or name in FRAME_TAGS:
        return False
    for key, value in ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key == "role" and value in ROLES:
            return True
        if key == "class" and "hidden" in value.split():
            return True
    return False


def word_mark(name: str, attrs: str, inside: bool) -> int:
    """What the words of class and id say of an element, ``inside`` an article or main or not."""
    if not attrs.strip() or name in FRAME_TAGS or name in TEXT_TAGS:
        return NONE
    mark = NONE
    for key, value in ATTR.findall(attrs):
        # Ids of inline elements are anchors.
        if key.lower() != "class" and (key.lower() != "id" or name not in BLOCKS | NOT_CONTENT):
            continue
        for one in value.strip("\"'").lower().split():
            parts = [p for p in re.split(r"[^a-z]+", one) if p]
            stems = [p for p in parts if p.startswith(STEMS) and not p.startswith("commentar")]
            marked = WORDS.intersection(parts).union(stems)
            if not marked or FRAME.intersection(parts):
                continue
            alone = marked.union(PLAIN).issuperset(parts)
            sure = not UNSURE.issuperset(marked)
            # A chapter's id is made from its heading.
            if name == "section" and key.lower() == "id":
                mark = max(mark, LAST if sure and alone else LINKED)
            else:
                framed = sure and alone if inside else sure or alone
                mark = max(mark, FRAMED if framed else LINKED)
    return mark


def class_of(attrs: str) -> str:
    """The class as a part of a path's element."""
    for key, value in ATTR.findall(attrs):
        if key.lower() == "class":
            words = value.strip("\"'").lower().replace("/", "_").split()
            return "".join(f".{word}" for word in words)
    return ""


def blocks_of(page: str) -> list[Block]:
    """``(path, text, characters inside links, vote of words)`` of each block of candidate text, in
    order."""
    out: list[tuple[str, str, int]] = []
    # Open block elements, whether they are left out, and the marked element that they belong to
    # by its number, mark and parent's path.
    stack: list[tuple[str, bool, Owner | None]] = []
    path: list[str] = []
    owners: list[Owner | None] = []
    parts: list[str] = []
    links = [0, 0]  # open links, and characters in links of this block
    off = 0  # open elements that are left out
    inline_off: list[str] = []

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(("/".join(path), text, links[1]))
                owners.append(stack[-1][2] if stack else None)
            parts.clear()
        links[1] = 0

    def pop_to(at: int) -> None:
        nonlocal off
        for _, bad, _ in stack[at:]:
            off -= bad
        del stack[at:], path[at:]

    at, end = 0, len(page)
    while at < end:
        found = TOKEN.search(page, at)
        stop = found.start() if found else end
        if stop > at and not off and not inline_off:
            text = html.unescape(page[at:stop])
            parts.append(text)
            if links[0]:
                links[1] += len("".join(text.split()))
        if not found:
            break
        at = found.end()
        name = found["name"]
        if not name:
            continue
        name = name.lower()
        if found["close"]:
            if name == "a":
                links[0] = 0
            if name in inline_off:
                del inline_off[inline_off.index(name) :]
            if name in BLOCKS or any(name == n for n, _, _ in stack):
                flush()
                place = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
                if place is not None:
                    pop_to(place)
                    links[0], inline_off = 0, []
            continue
        attrs = found["attrs"] or ""
        empty = attrs.endswith("/") and not UNQUOTED.search(attrs)
        if name in RAW:
            shut = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
            if shut or not empty:
                at = shut.start() if shut else end
            continue
        if name in BREAKS:
            flush()
        if name in VOID:
            continue
        bad = named_otherwise(name, attrs)
        inner = stack[-1][0] if stack else ""
        inside = any(n in WHOLE for n, _, _ in stack)
        if name in BLOCKS or inner not in HEADINGS:
            mark = word_mark(name, attrs, inside)
        else:
            mark = NONE
        if empty and (bad or mark or name not in BLOCKS):
            continue
        if name in BLOCKS or name in NOT_CONTENT:
            flush()
            kinds, bounds = CLOSES.get(name, ({"p"}, {"td", "th", "li", "div", "article", "section"}))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in kinds:
                    pop_to(k)
                    break
                if stack[k][0] in bounds or (stack[k][0] == "p" and name not in BLOCKS):
                    break
            links[0], inline_off = 0, []
            owner = stack[-1][2] if stack else None
            if mark > (owner[1] if owner else NONE):
                owner = (at, mark, "/".join(path))
            stack.append((name, bad, owner))
            path.append(name + class_of(attrs))
            off += bad
        elif bad or mark == FRAMED:
            # Inline elements have no path to score.
            inline_off.append(name)
        elif name == "a":
            links[0] = 1
    flush()
    votes = word_votes(out, owners)
    return [(*block, vote) for block, vote in zip(out, votes)]


def word_votes(blocks: list[tuple[str, str, int]], owners: list[Owner | None]) -> list[float]:
    """1 for a block that belongs to no marked element, or to one that its links and place clear."""
    sums: dict[Owner, list[int]] = defaultdict(lambda: [0, 0, 0])
    for k, ((_, text, linked), owner) in enumerate(zip(blocks, owners)):
        if owner:
            own = sums[owner]
            own[0], own[1], own[2] = own[0] + linked, own[1] + len("".join(text.split())), k
    ends: dict[str, int] = {}  # the last unmarked text below each path
    if any(mark == LAST for _, mark, _ in sums):
        for k, ((path, text, linked), owner) in enumerate(zip(blocks, owners)):
            if owner is None and linked < LINKS_MOST * len("".join(text.split())):
                names = path.split("/") if path else []
                for depth in range(len(names) + 1):
                    ends["/".join(names[:depth])] = k
    cleared = {None}
    for owner, (linked, size, last) in sums.items():
        _, mark, parent = owner
        followed = mark == LAST and ends.get(parent, -1) > last
        if linked < LINKS_MOST * size and (mark == LINKED or followed):
            cleared.add(owner)
    return [1.0 if owner in cleared else WORD_VOTE for owner in owners]


def tag(name: str) -> str:
    """A path's element without its class."""
    return name.split(".", 1)[0]


def whole_of(path: str) -> str | None:
    """The outermost article or main element of a path."""
    names = path.split("/")
    at = next((k for k, name in enumerate(names) if tag(name) in WHOLE), None)
    return None if at is None else "/".join(names[: at + 1])


def container_of(path: str) -> str:
    return "/".join(takewhile(lambda name: tag(name) in CONTAINERS, path.split("/")))


def path_scores(blocks: list[Block]) -> tuple[dict[tuple[str, float], float], float]:
    """The fused score of each path (and vote of words), and the page's mean score. The mean
    weighs a path by its length of text times its votes, so that frame does not lower the bar."""
    keys = [(path, vote) for path, _, _, vote in blocks]
    sums: dict[tuple[str, float], np.ndarray] = defaultdict(lambda: np.zeros(5))
    for key, (_, text, linked, _) in zip(keys, blocks):
        filled = len("".join(text.split()))
        sums[key] += (1, len(text), len(PUNCTUATION.findall(text)), linked, filled)
    ratio = np.array([sums[k][1:3] / sums[k][0] for k in keys])
    # Only neighbours in one container lend to each other.
    homes = [container_of(path) for path, _ in keys]
    same = np.array([a == b for a, b in zip(homes, homes[1:])], dtype=bool)[:, None]
    before, after = ratio.copy(), ratio.copy()
    before[1:] = np.where(same, ratio[:-1], ratio[1:])
    after[:-1] = np.where(same, ratio[1:], ratio[:-1])
    smooth = SMOOTH[0] * before + SMOOTH[1] * ratio + SMOOTH[2] * after
    fused = np.sqrt(smooth[:, 0] * (smooth[:, 1] + 0.1))
    totals: dict[tuple[str, float], float] = defaultdict(float)
    for key, score in zip(keys, fused.tolist()):
        totals[key] += score
    has_whole = any(whole_of(path) is not None for path, _ in sums)
    scores, mean, weights = {}, 0.0, 0.0
    for key, (count, length, _, linked, filled) in sums.items():
        path, vote = key
        vote *= max(1 - linked / filled, 0.0)
        if has_whole and whole_of(path) is None:
            vote *= PLACE_VOTE
        scores[key] = totals[key] / count * vote
        mean += scores[key] * length * vote
        weights += length * vote
    return scores, mean / weights if weights else 0.0


def main_blocks(blocks: list[Block]) -> list[str]:
    if not blocks:
        return []
    scores, mean = path_scores(blocks)
    content = {key for key, score in scores.items() if score >= SCORE_SHARE * mean}
    # Where words speak against all that has a score, the page has no article.
    if all(vote < 1.0 or not scores[path, vote] for path, vote in content):
        content = {(path, vote) for path, vote in content if vote == 1.0}
    homes: set[str] = set()
    for path, vote in content:
        if vote == 1.0 and tag(path.rsplit("/", 1)[-1]) not in HEADINGS:
            homes |= {container_of(path), whole_of(path) or ""}

    def at_home(path: str) -> bool:
        home = container_of(path)
        if home in homes and (home or not path or path in TEXT_TAGS):
            return True
        names = home.split("/")
        above = ("/".join(names[:k]) for k in range(len(names), 0, -1))
        return any(h in homes and tag(h.rsplit("/", 1)[-1]) not in PAGE for h in above)

    kept = []
    for path, text, linked, vote in blocks:
        only_links = linked >= LINKS_ONLY * len("".join(text.split()))
        kept.append((path, vote) in content or (vote == 1.0 and not only_links and at_home(path)))
    below = False
    for k in range(len(blocks) - 1, -1, -1):
        path, _, _, vote = blocks[k]
        if tag(path.rsplit("/", 1)[-1]) in HEADINGS and vote == 1.0:
            kept[k] = kept[k] or below
        else:
            below = kept[k]
    return [block[1] for block, keep in zip(blocks, kept) if keep]


def extract(
    pages: DataFrame, html_col: str = "html", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (all by default) with ``text`` and ``n_chars``; columns of those names
    are replaced."""
    mine = ["text", "n_chars"]
    rest = pages.drop(*[c for c in mine if c != html_col])
    names = [c for c in keep or rest.columns if c not in mine]
    schema = T.StructType([rest.schema[c] for c in names])
    schema = schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, html_col):
            found = ["\n".join(main_blocks(blocks_of(t))) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names],
                    pa.array(found, pa.string()),
                    pa.array([len(t) for t in found], pa.int64()),
                ],
                names=[*names, *mine],
            )

    return rest.mapInArrow(run, schema)
