"""Figures with their captions and citing paragraphs out of article XML.

One article gives many rows, so parsing is a ``mapInArrow`` over (path, content) frames; filters on article metadata belong
before it.  Well-formed articles go through the standard library's parser; others through a tolerant tree builder that closes
what is left open, and rows tell which way was taken.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from figcurate.functions.text import canonical_license_text, pmcid_of
from figcurate.schemas import FIGURE_TEXT

#: Floating objects whose text does not belong to the paragraph around them (fixed values).
FLOATS = frozenset(
    "fig fig-group table-wrap table-wrap-group supplementary-material media boxed-text disp-formula disp-formula-group "
    "preformat code".split()
)
_GRAPHICS = ("graphic", "media", "inline-graphic")


def _tidy(text: str) -> str:
    return " ".join(text.split())


def _local(node: ET.Element) -> str:
    tag = node.tag
    return tag.rpartition("}")[2].rpartition(":")[2] if isinstance(tag, str) else ""


def _attribute(node: ET.Element, name: str) -> str:
    """An attribute whatever its namespace."""
    for key, value in node.attrib.items():
        if key.rpartition("}")[2].rpartition(":")[2] == name:
            return value or ""
    return ""


def _text(node: ET.Element, without: frozenset[str] = frozenset()) -> str:
    """The text of a node and of all below it, leaving out what lies in elements of ``without``."""
    parts: list[str] = []

    def walk(x: ET.Element, top: bool) -> None:
        if top or _local(x) not in without:
            if isinstance(x.tag, str):
                parts.append(x.text or "")
                for child in x:
                    walk(child, False)
        if not top:
            parts.append(x.tail or "")

    walk(node, True)
    return _tidy("".join(parts))


class _Tolerant(HTMLParser):
    """A tree from broken markup: unknown closings are ignored, missing ones implied."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = ET.Element("document")
        self.stack = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.stack.append(ET.SubElement(self.stack[-1], tag, {k: v or "" for k, v in attrs}))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        ET.SubElement(self.stack[-1], tag, {k: v or "" for k, v in attrs})

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag == tag:
                del self.stack[at:]
                return

    def handle_data(self, data: str) -> None:
        top = self.stack[-1]
        if len(top):
            top[-1].tail = (top[-1].tail or "") + data
        else:
            top.text = (top.text or "") + data


def article_tree(content: bytes) -> tuple[ET.Element, str]:
    """The tree of an article and how it was read: ``strict`` or ``recovered``; raises ValueError if there is no element."""
    try:
        return ET.fromstring(content), "strict"
    except ET.ParseError:
        builder = _Tolerant()
        builder.feed(content.decode("utf-8", errors="replace"))
        builder.close()
        if not len(builder.root):
            raise ValueError("no markup found") from None
        return builder.root, "recovered"


def _first(root: ET.Element, *names: str) -> str:
    """The text of the first element of any of the names, in document order."""
    return next((_text(x) for x in root.iter() if _local(x) in names), "")


def _article_id(root: ET.Element, *kinds: str) -> str:
    for node in root.iter():
        if _local(node) == "article-id" and node.get("pub-id-type", "").strip().lower() in kinds and (value := _text(node)):
            return value
    return ""


def article_license(root: ET.Element) -> str:
    """The first licence an article states that is not blank: its custom field, then per licence element type, links and text."""
    stated: list[str] = []
    for node in root.iter():
        if _local(node) == "custom-meta":
            names = [x for x in node if _local(x) == "meta-name" and _tidy(x.text or "") == "pmc-license-ref"]
            values = [x for x in node if _local(x) == "meta-value"]
            if names and values:
                stated.append(_text(values[0]))
    for node in root.iter():
        if _local(node) == "license":
            stated.append(node.get("license-type", ""))
            stated += [_attribute(x, "href") for x in node.iter() if _local(x) in ("license_ref", "ext-link")]
            stated.append(_text(node))
    return next((code for s in stated if (code := canonical_license_text(s))), "")


def _caption(node: ET.Element) -> str:
    """The titles and paragraphs that lie in no other title or paragraph, else the whole text."""
    blocks: list[str] = []

    def walk(x: ET.Element) -> None:
        for child in x:
            if _local(child) in ("title", "p"):
                blocks.append(_text(child))
            else:
                walk(child)

    walk(node)
    return " ".join(b for b in blocks if b) or _text(node)


def citing_paragraphs(root: ET.Element) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
    """By figure id the distinct paragraphs that refer to it: without floating objects, and in full."""
    parent = {child: node for node in root.iter() for child in node}
    plain: dict[str, dict[str, None]] = {}
    full: dict[str, dict[str, None]] = {}
    for node in root.iter():
        if _local(node) != "xref" or node.get("ref-type", "").lower() != "fig":
            continue
        around = parent.get(node)
        while around is not None and _local(around) != "p":
            around = parent.get(around)
        if around is None:
            continue
        for figure in node.get("rid", "").split():
            for store, value in ((plain, _text(around, FLOATS)), (full, _text(around))):
                if value:
                    store.setdefault(figure, {})[value] = None
    return {k: list(v) for k, v in plain.items()}, {k: list(v) for k, v in full.items()}


def figures_of(content: bytes, source: str = "", metadata: dict | None = None, require_caption: bool = True) -> list[dict]:
    """The figure rows of one article.

    What the metadata say of article id, version, PubMed id, licence and title goes before what the article says.  Figures
    without an id are numbered by their place among all figures, before those without a caption are left out.
    """
    root, how = article_tree(content)
    given = {k: v for k, v in (metadata or {}).items() if v}
    pmcid = next(filter(None, map(pmcid_of, (given.get("pmcid"), given.get("accession_id"), _article_id(root, "pmcid", "pmc")))), "")
    version = next((given[k] for k in ("article_version", "versioned_pmcid", "pmcid_ver") if k in given), "") or _article_id(
        root, "pmcid-ver", "pmc-version", "pmcid-version"
    )
    license_code = (
        canonical_license_text(given.get("license_code")) or canonical_license_text(given.get("license")) or article_license(root)
    )
    plain, full = citing_paragraphs(root)
    rows = []
    for number, figure in enumerate((x for x in root.iter() if _local(x) == "fig"), 1):
        name = figure.get("id") or f"fig-{number:04d}"
        captions = [x for x in figure if _local(x) == "caption"]
        labels = [x for x in figure if _local(x) == "label"]
        caption = _caption(captions[0]) if captions else ""
        if require_caption and not caption:
            continue
        hrefs = dict.fromkeys(h for x in figure.iter() if x is not figure and _local(x) in _GRAPHICS and (h := _attribute(x, "href")))
        references, recursive = plain.get(name, []), full.get(name, [])
        rows.append(
            {
                "pmcid": pmcid, "article_version": str(version), "pmid": str(given.get("pmid") or _article_id(root, "pmid")),
                "article_title": given.get("title") or _first(root, "article-title"),
                "journal_title": _first(root, "journal-title", "journal-id"), "license": license_code or "",
                "figure_id": name, "figure_label": _text(labels[0]) if labels else "", "caption": caption,
                "reference_texts": references, "reference_texts_screening": recursive if recursive != references else None,
                "image_hrefs": list(hrefs), "source_xml": source, "parsed": how,
            }
        )
    return rows


METADATA = "struct<pmcid: string, article_version: string, pmid: string, license: string, title: string>"


def parse_articles(articles: DataFrame, require_caption: bool = True, keep_failures: bool = False) -> DataFrame:
    """FIGURE_TEXT rows of (path, content, metadata) articles, with ``parsed`` (strict, recovered or failed).

    ``metadata`` is a struct as in ``METADATA`` or null.  Articles that cannot be read give one row with ``parsed`` = failed if
    ``keep_failures``, else none.
    """
    schema = T.StructType([*FIGURE_TEXT.fields, T.StructField("parsed", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[dict] = []
            for article in batch.to_pylist():
                try:
                    rows += figures_of(article["content"] or b"", article["path"] or "", article["metadata"], require_caption)
                except Exception:
                    if keep_failures:
                        rows.append(dict.fromkeys(arrow.names) | {"source_xml": article["path"], "parsed": "failed"})
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    if "metadata" not in articles.columns:
        articles = articles.withColumn("metadata", F.lit(None).cast(METADATA))
    return articles.select("path", "content", "metadata").mapInArrow(run, schema)
