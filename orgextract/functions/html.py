"""HTML elements and anchors as rows (JN5), by the standard parser in Arrow batches; void elements never nest.

A page is parsed once per call. `html_elements` gives every element, with its text on one line;
`html_anchors` gives the links alone, with the texts of up to three ancestors in lines, as a reader
sees them, so no join brings an element and its parents together.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BREAKS = {"address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4",
           "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "table", "tr", "ul"}
_HIDDEN = {"script", "style"}
SCHEMA = "ord int, parent_ord int, tag string, attrs map<string,string>, text string"
ANCHOR_SCHEMA = "ord int, attrs map<string,string>, text string, up array<string>, cf string"
ANCESTORS = 3


class _Tree(HTMLParser):
    """Elements in order, each with its parent and the range of text pieces it spans."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []  # ord, parent, tag, attrs, first piece, end piece, end row
        self.open: list[int] = []
        self.pieces: list[str] = []
        self.hidden: list[bool] = []

    def _piece(self, text: str, hidden: bool = False) -> None:
        self.pieces.append(text)
        self.hidden.append(hidden)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _BREAKS:
            self._piece("\n")
        here = len(self.pieces)
        self.rows.append([len(self.rows), self.open[-1] if self.open else None, tag, {k: v or "" for k, v in attrs}, here, here if tag in _VOID else None, None])
        if tag not in _VOID:
            self.open.append(len(self.rows) - 1)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[i]][2] == tag:
                for at in self.open[i:]:
                    self.rows[at][5:] = len(self.pieces), len(self.rows)
                del self.open[i:]
                if tag in _BREAKS:
                    self._piece("\n")
                return

    def handle_data(self, data: str) -> None:
        self._piece(data, bool(self.open) and self.rows[self.open[-1]][2] in _HIDDEN)

    def parts(self, row: list) -> list[str]:
        end = len(self.pieces) if row[5] is None else row[5]
        own = row[2] in _HIDDEN
        return [p for p, h in zip(self.pieces[row[4] : end], self.hidden[row[4] : end]) if own or not h]

    def line(self, row: list) -> str:
        return " ".join("".join(self.parts(row)).split())

    def lines(self, row: list) -> str:
        found = (" ".join(x.split()) for x in "".join(self.parts(row)).split("\n"))
        return "\n".join(x for x in found if x)


def _tree(html: str | None) -> _Tree:
    tree = _Tree()
    tree.feed(html or "")
    return tree


def elements_of(html: str | None) -> list[tuple]:
    tree = _tree(html)
    return [(r[0], r[1], r[2], r[3], tree.line(r)) for r in tree.rows]


def anchors_of(html: str | None) -> list[tuple]:
    """ord, attrs, text, ancestors' texts from the parent up, and the encoded address of an element inside, if any."""
    if not html or "<a" not in html.lower():
        return []
    tree, out, texts = _tree(html), [], {}
    for r in tree.rows:
        if r[2] != "a":
            continue
        up, at = [], r[1]
        while at is not None and len(up) < ANCESTORS:
            if at not in texts:
                texts[at] = tree.lines(tree.rows[at])
            up.append(texts[at])
            at = tree.rows[at][1]
        coded = (x[3]["data-cfemail"] for x in tree.rows[r[0] : r[6]] if "data-cfemail" in x[3])
        out.append((r[0], r[3], tree.line(r), up, next(coded, None)))
    return out


def _rows(df: DataFrame, keys: list[str], html: str, read, columns: list[str], schema: str) -> DataFrame:
    kinds = ", ".join(f"k{i} {df.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    names = [f"k{i}" for i in range(len(keys))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(*k, *e) for *k, h in b.itertuples(index=False, name=None) for e in read(h)]
            out = pd.DataFrame(rows, columns=[*names, *columns])
            yield out.astype({"parent_ord": "Int32"}) if "parent_ord" in columns else out

    slim = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(html).alias("h"))
    return slim.mapInPandas(run, f"{kinds}, {schema}").withColumnsRenamed(dict(zip(names, keys)))


def html_elements(df: DataFrame, key: str, html: str) -> DataFrame:
    """key, ord, parent_ord, tag, attrs, text: one row per element; null or empty HTML gives none."""
    return _rows(df, [key], html, elements_of, ["ord", "parent_ord", "tag", "attrs", "text"], SCHEMA)


def html_anchors(df: DataFrame, keys: list[str], html: str) -> DataFrame:
    """keys, ord, attrs, text, up (texts of up to three ancestors, nearest first, in lines), cf: one row per link."""
    return _rows(df, keys, html, anchors_of, ["ord", "attrs", "text", "up", "cf"], ANCHOR_SCHEMA)


def ancestor_text(elements: DataFrame, key: str, levels: int = 1) -> DataFrame:
    """JN5: elements with the text of their ancestor `levels` up, by equi-joins on (key, parent)."""
    out = elements.withColumn("_up", F.col("parent_ord"))
    for i in range(levels):
        up = elements.select(F.col(key).alias("_k"), F.col("ord").alias("_o"), F.col("parent_ord").alias("_pp"), F.col("text").alias(f"text_up{i + 1}"))
        out = out.join(up, (out[key] == up["_k"]) & (out["_up"] == up["_o"]), "left").drop("_k", "_o", "_up").withColumnRenamed("_pp", "_up")
    return out.drop("_up")
