"""Rows from HTML pages: a small element tree and selectors over it, run as Arrow-batched functions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Node:
    """Element with its attributes and children (elements or strings)."""

    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def all(self, tag: str, css: str) -> list[Node]:
        return [n for n in self.walk() if n.tag == tag and css in n.attrs.get("class", "")]

    def first(self, tag: str, css: str) -> Node | None:
        return next((n for n in self.walk() if n.tag == tag and css in n.attrs.get("class", "")), None)

    def text(self) -> str:
        parts, stack = [], [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                parts.append(item)
            else:
                stack.extend(reversed(item.children))
        return re.sub(r"\s+", " ", " ".join(parts)).strip()


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def tree(page: str | None) -> Node:
    parser = _Tree()
    parser.feed(page or "")
    parser.close()
    return parser.root


def search_cards(page: str | None) -> list[dict]:
    """Cards of a search page: those with an id and an address, whose parameters are dropped."""
    out = []
    for card in tree(page).walk():
        urn = card.attrs.get("data-entity-urn", "")
        if "urn:li:jobPosting:" not in urn:
            continue
        link, stamp = card.first("a", "base-card__full-link"), card.first("time", "job-search-card__listdate")
        url = link.attrs.get("href", "").partition("?")[0] if link else ""
        read = lambda tag, css, card=card: n.text() if (n := card.first(tag, css)) else None
        row = {
            "linkedin_job_id": urn.rpartition(":")[2],
            "url": url,
            "title": read("h3", "base-search-card__title"),
            "company": read("h4", "base-search-card__subtitle"),
            "location": read("span", "job-search-card__location"),
            "posted_at": stamp.attrs.get("datetime") if stamp else None,
        }
        if row["linkedin_job_id"] and url:
            out.append(row)
    return out


def detail_page(page: str | None) -> dict:
    """Title, company, location and description of a posting's page; empty where the page has none."""
    root = tree(page)
    read = lambda tag, css: n.text() if (n := root.first(tag, css)) else ""
    body = next((n for n in root.walk() if "show-more-less-html__markup" in n.attrs.get("class", "")), None)
    return {
        "title": read("h2", "top-card-layout__title"),
        "company": read("a", "topcard__org-name-link"),
        "location": read("span", "topcard__flavor--bullet"),
        "description": body.text() if body else "",
    }


def result_rows(page: str | None, base_url: str | None) -> list[dict]:
    """Rows of a result table: title, absolute address and location; rows without the first two are left out."""
    out = []
    for row in tree(page).all("tr", "data-row"):
        link, cell = row.first("a", "jobTitle-link"), row.first("td", "colLocation")
        if link and link.text() and link.attrs.get("href"):
            out.append({"title": link.text(), "location": cell.text() if cell else "", "url": urljoin(base_url or "", link.attrs["href"])})
    return out


def job_description(page: str | None) -> str:
    node = tree(page).first("span", "jobdescription")
    return node.text() if node else ""


CARD = "array<struct<linkedin_job_id:string,url:string,title:string,company:string,location:string,posted_at:string>>"
DETAIL = "struct<title:string,company:string,location:string,description:string>"
RESULT = "array<struct<title:string,location:string,url:string>>"


def _cards(s: pd.Series) -> pd.Series:
    return s.map(search_cards)


def _details(s: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([detail_page(v) for v in s], columns=["title", "company", "location", "description"])


def _results(pages: pd.Series, bases: pd.Series) -> pd.Series:
    return pd.Series([result_rows(p, b) for p, b in zip(pages, bases, strict=True)])


def _descriptions(s: pd.Series) -> pd.Series:
    return s.map(job_description)


def cards(html: Column) -> Column:
    return F.pandas_udf(_cards, CARD)(html)


def details(html: Column) -> Column:
    return F.pandas_udf(_details, DETAIL)(html)


def results(html: Column, base_url: Column) -> Column:
    return F.pandas_udf(_results, RESULT)(html, base_url)


def descriptions(html: Column) -> Column:
    return F.pandas_udf(_descriptions, "string")(html)
