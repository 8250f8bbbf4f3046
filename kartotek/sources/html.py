"""Category tree of a landed HTML page.

The only reader that needs Python: list nesting is beyond regular expressions in SQL.
It runs in ``mapInPandas``, one Arrow batch at a time, on pages alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartotek import functions as fn

# Fixed value: class prefix of tree items; the suffix says which kind of node it is.
NODE_CLASS = re.compile(r"AspNet-TreeView-(Root|Parent|Leaf)(?![\w-])")

_NOISE = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>", re.S | re.I)
_TOKEN = re.compile(r"<(/?)(li|a)\b((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[^>]*>|([^<]+)", re.I)
_ATTRIBUTE = {
    name: re.compile(rf"\b{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
    for name in ("class", "href")
}


def _attribute(text: str, name: str) -> str:
    found = _ATTRIBUTE[name].search(text)
    return html.unescape(next((g for g in found.groups() if g is not None), "")) if found else ""


def tree_links(page: str) -> Iterator[tuple[str, str, list[str]]]:
    """``(href, title, ancestor names)`` of every leaf, in page order of their ends."""
    open_items: list[dict] = []
    for closing, tag, attributes, text in _TOKEN.findall(_NOISE.sub("", page)):
        if text:
            if open_items:
                open_items[-1]["text"] += html.unescape(text)
        elif tag.lower() == "a":
            if not closing and open_items:
                open_items[-1]["href"] = _attribute(attributes, "href")
        elif tag and not closing:
            kind = NODE_CLASS.search(_attribute(attributes, "class"))
            open_items.append({"kind": kind and kind.group(1), "text": "", "href": ""})
        elif tag and open_items:
            item = open_items.pop()
            if item["kind"] == "Leaf" and item["href"]:
                above = [o["text"] for o in open_items if o["kind"] in ("Root", "Parent")]
                yield item["href"], item["text"], above


def web_catalog(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """One row per leaf link below its page's root, with the ids taken from the link."""
    schema = f"{url} string, item_pos int, raw_href string, raw_title string, names array<string>"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (address, pos, href, title, names)
                for address, page in zip(batch[url], batch[body])
                for pos, (href, title, names) in enumerate(tree_links(page or ""))
            ]
            yield pd.DataFrame(rows, columns=[url, "item_pos", "raw_href", "raw_title", "names"])

    links = pages.select(url, body).mapInPandas(read, schema)
    ids = fn.ids_from_href(F.col("raw_href"), F.size("names"))
    return links.withColumn("_ids", ids).select(
        url,
        "item_pos",
        F.col("_ids.table_id").alias("table_id"),
        F.col("_ids.category_ids").alias("category_ids"),
        F.transform("names", fn.squeeze).alias("category_names"),
        fn.squeeze(F.col("raw_title")).alias("title"),
        fn.url_join(F.col(url), F.col("raw_href")).alias("href"),
    )
