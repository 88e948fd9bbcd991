"""HTML and feed sources. What regular expressions can say stays in the JVM; whole documents are parsed in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = frozenset("address article aside blockquote br dd div dl dt footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tr ul".split())
SILENT = frozenset(("script", "style", "button"))


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.silent = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self.silent += 1
        elif tag in BLOCKS:
            self.out.append("\n")
        elif tag == "sup":
            self.out.append(" ")

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.silent:
            self.out.append(data)


def parse_text(html: str | None) -> str | None:
    """X-01, full form: every entity, nested tags, superscripts kept apart from the number before them (21<sup>1</sup> is '21 1')."""
    import re

    if html is None:
        return None
    parser = _Text()
    parser.feed(html)
    parser.close()
    text = re.sub(r"[ \t\r ]+", " ", "".join(parser.out))
    return re.sub(r"\n{3,}", "\n\n", re.sub(r" ?\n ?", "\n", text)).strip()


def with_text(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """pages plus the text of its HTML column."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(parse_text, na_action="ignore")

    return pages.withColumn(name, texts(html))


def links(html: Column) -> Column:
    """S-19, S-23: targets of the links of a page, in order."""
    return F.regexp_extract_all(html, F.lit(r"(?i)href=\"([^\"]*)\""))


def labelled(html: Column, label: str = "dt", value: str = "dd") -> Column:
    """S-20, S-24: map of a page's label and value cells; the values of a repeated label are joined with '; '."""
    pairs = F.regexp_extract_all(html, F.lit(rf"(?is)<{label}[^>]*>(.*?)</{label}>\s*<{value}[^>]*>.*?</{value}>"), F.lit(0))
    bare = lambda s: F.trim(F.regexp_replace(s, r"<[^>]*>", ""))
    item = F.transform(pairs, lambda p: F.struct(bare(F.regexp_extract(p, rf"(?is)<{label}[^>]*>(.*?)</{label}>", 1)).alias("k"), bare(F.regexp_extract(p, rf"(?is)<{value}[^>]*>(.*?)</{value}>", 1)).alias("v")))
    keys = F.array_distinct(F.transform(item, lambda i: i["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.array_join(F.transform(F.filter(item, lambda i: i["k"] == k), lambda i: i["v"]), "; ")))


def feed_items(xml: Column) -> Column:
    """S-22: items of a feed as an array of (title, link, published); a document type or entity declaration makes the feed null."""
    field = lambda x, name: F.trim(F.regexp_replace(F.regexp_extract(x, rf"(?is)<{name}[^>]*>(.*?)</{name}>", 1), r"^<!\[CDATA\[|\]\]>$", ""))
    items = F.transform(F.regexp_extract_all(xml, F.lit(r"(?is)<item\b[^>]*>(.*?)</item>")), lambda x: F.struct(field(x, "title").alias("title"), field(x, "link").alias("link"), field(x, "pubDate").alias("published")))
    return F.when(~xml.rlike(r"(?i)<!(?:DOCTYPE|ENTITY)"), items)
