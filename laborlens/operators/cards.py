"""Job cards of the two boards' list pages (A7) as a column expression.

Cards are nested markup, so a card's block can't be cut out by a regex; a small
tree is built per page with the standard library's parser (Arrow pandas UDF,
shipped by value like the similarity kernel). Pages without a card's class name
are never sent to Python.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = ["title", "company", "location", "experience", "salary", "posted_date", "job_url"]
CARD_SCHEMA = f"array<struct<{','.join(f'{f}:string' for f in FIELDS)}>>"
CARD_CLASS_RE = "jobTuple|srp-jobtuple-wrapper|base-card|result-card"

# The boards' class names. Per board: the card elements, then each field's element (the first in document order).
BOARD_A = (["article.jobTuple", "div[class*='srp-jobtuple-wrapper']"], {
    "title": ["a.title", "[class*='title']"], "company": ["a.subTitle", "[class*='comp-name']"],
    "location": ["li.location span", "[class*='loc-wrap']"], "experience": ["li.experience span", "[class*='exp-wrap']"],
    "salary": ["li.salary span", "[class*='salary']"], "posted_date": ["span.date", "[class*='job-post-day']"]})
BOARD_B = (["div.base-card", "li.result-card"], {
    "title": ["h3.base-search-card__title", "h3.result-card__title"],
    "company": ["h4.base-search-card__subtitle", "h4.result-card__subtitle"],
    "location": ["span.job-search-card__location"], "posted_date": ["time"],
    "job_url": ["a.base-card__full-link", "a.result-card__full-card-link"]})

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
STEP_RE = re.compile(r"^(\w+)?(?:\.([\w-]+))?(?:\[class\*='([^']+)'\])?$")


class Node:
    def __init__(self, tag: str, attrs: dict, parent):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def descendants(self):
        todo = self.children[::-1]
        while todo:
            n = todo.pop()
            if isinstance(n, Node):
                yield n
                todo.extend(n.children[::-1])

    def text(self) -> str:
        """The stripped text pieces in document order, joined without a separator."""
        out, todo = [], [self]
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                out.append(n.strip())
            elif n.tag not in ("script", "style"):
                todo.extend(n.children[::-1])
        return "".join(out)


class Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag == "li":  # an open item of the same list ends here
            n = self.at
            while n is not self.root and n.tag not in ("li", "ul", "ol"):
                n = n.parent
            if n.tag == "li":
                self.at = n.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        n = self.at
        while n is not self.root and n.tag != tag:
            n = n.parent
        if n is not self.root:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


SPACE = r"[ \t\n\r\f]"
ATTR = rf"""{SPACE}+([a-zA-Z][a-zA-Z0-9_-]*)(?:=(?:"([^"&<>]*)"|'([^'&<>]*)'))?(?={SPACE}|$)"""
# a text, a start tag or an end tag as nearly all markup is written
TOKEN_RE = re.compile(rf"""([^<]+)|<([a-zA-Z][a-zA-Z0-9]*)((?:{SPACE}+[a-zA-Z][a-zA-Z0-9_-]*(?:=(?:"[^"&<>]*"|'[^'&<>]*'))?)*){SPACE}*>"""
                      rf"""|</([a-zA-Z][a-zA-Z0-9]*){SPACE}*>""")
ATTR_RE = re.compile(ATTR)
# a script whose body has nothing that looks like markup; its text is never read
SCRIPT_RE = re.compile(rf"[^<]*</script{SPACE}*>", re.I)
#: elements whose content is not markup: left to the standard library's parser
RAW = {"style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext", "svg", "math"}


@lru_cache(maxsize=4096)
def attributes(text: str) -> dict:
    return {k.lower(): a or b for k, a, b in ATTR_RE.findall(text)}


def plain_tree(html: str):
    """The tree that ``Tree`` builds, several times as fast, for a page of plain texts and
    tags; None for any other page (comments, references in attributes, raw text)."""
    tree = Tree()
    at, end = 0, len(html)
    match = TOKEN_RE.match
    while at < end:
        m = match(html, at)
        if m is None:
            return None
        text, tag, attrs, closed = m.groups()
        at = m.end()
        if text is not None:
            if "&" in text:
                if at == end:
                    return None
                text = unescape(text)
            tree.at.children.append(text)
        elif tag is not None:
            tag = tag.lower()
            if tag in RAW:
                return None
            tree.handle_starttag(tag, attributes(attrs).items() if attrs else ())
            if tag == "script":
                m = SCRIPT_RE.match(html, at)
                if m is None:
                    return None
                tree.handle_endtag("script")
                at = m.end()
        else:
            tree.handle_endtag(closed.lower())
    return tree


@lru_cache(maxsize=1024)
def step(selector: str) -> tuple:
    return STEP_RE.match(selector).groups()


@lru_cache(maxsize=65536)
def fits(tag: str, cls: str, selector: str) -> bool:
    """Does an element of this name and class match one step?"""
    want, token, part = step(selector)
    return not ((want and want != tag) or (token and token not in cls.split()) or (part and part not in cls))


def matches(node: Node, selector: str) -> bool:
    """Does the node match "tag.class", "[class*='part']" or "outer inner"?"""
    outer, _, last = selector.rpartition(" ")
    if not fits(node.tag, node.attrs.get("class", ""), last):
        return False
    if not outer:
        return True
    up = node.parent
    while up is not None and not matches(up, outer):
        up = up.parent
    return up is not None


@lru_cache(maxsize=65536)
def may(tag: str, cls: str, selectors: tuple) -> bool:
    """Does an element of this name and class match the last step of any selector?"""
    return any(fits(tag, cls, s.rpartition(" ")[2]) for s in selectors)


def first(nodes: list[Node], selectors: list[str]):
    """The first node that matches any selector."""
    some = tuple(selectors)
    return next((n for n in nodes if may(n.tag, n.attrs.get("class", ""), some) and any(matches(n, s) for s in selectors)), None)


def href(node) -> str:
    """The link of a node, or of the first link inside it."""
    if node is None:
        return ""
    return node.attrs.get("href") or next((n.attrs["href"] for n in node.descendants() if n.attrs.get("href")), "")


def parse_cards(html: str) -> list[dict]:
    """Every card of a page in document order; a missing field is ""."""
    tree = plain_tree(html)
    if tree is None:
        tree = Tree()
        tree.feed(html)
        tree.close()
    out = []
    for node in tree.root.descendants():
        for cards, fields in (BOARD_A, BOARD_B):
            if may(node.tag, node.attrs.get("class", ""), tuple(cards)):  # one step each
                inside = list(node.descendants())
                tags = {f: first(inside, sel) for f, sel in fields.items()}
                card = {f: tags[f].text() if tags.get(f) else "" for f in FIELDS}
                if tags["posted_date"] is not None and tags["posted_date"].tag == "time":
                    card["posted_date"] = tags["posted_date"].attrs.get("datetime") or card["posted_date"]
                card["job_url"] = href(tags["job_url"] if "job_url" in fields else tags["title"])
                out.append(card)
    return out


def board_cards(html: Column) -> Column:
    """The board cards of a page as array<struct<FIELDS>> (empty if it has none)."""
    import sys

    from pyspark import cloudpickle
    try:
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except ValueError:  # already registered
        pass

    @F.pandas_udf("string")
    def _cards(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: None if p is None else json.dumps(parse_cards(p)))

    found = F.from_json(_cards(F.when(html.rlike(CARD_CLASS_RE), html)), CARD_SCHEMA)
    return F.coalesce(found, F.from_json(F.lit("[]"), CARD_SCHEMA))
