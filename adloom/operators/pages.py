"""Ad pages to article records.

Only the HTML column (and the job type) crosses to Python, in Arrow batches; the
rest of the row stays in the JVM. The extraction is one output row per input row,
so no join back is needed. A page that does not have the expected layout keeps
its row, with the reason in ``error``.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.functions import markup
from adloom.functions.markup import Node, Page
from adloom.functions.values import ad_type_of_url, job_type_of_url
from adloom.schemas import ARTICLE_JOB_TYPES, POSITION_JOB_TYPES

# The extractor travels with the task; workers need no installed copy of it.
cloudpickle.register_pickle_by_value(markup)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: the label of the section that holds a job article.
ARTICLE_LABEL = "Jobbdetaljer"
NBSP = "\u00a0"

RECORD_DDL = (
    "article_header string, article_content string, about_section_content string, "
    "keywords string, section_count int, attributes map<string,string>, error string"
)


class LayoutError(ValueError):
    pass


def _need(node: Node | None, what: str) -> Node:
    if node is None:
        raise LayoutError(f"no {what}")
    return node


def _items(page: Page, node: Node | None) -> list[Node]:
    return [item for item in page.inside(node, "li") if item.kids] if node else []


def header_attributes(page: Page, node: Node | None) -> dict[str, str]:
    """``li`` items as label -> value: the first child, and the ``span`` (else the
    last child)."""
    return {
        page.text(item.kids[0]).lower().strip(): page.text(page.first(item, "span") or item.kids[-1])
        for item in _items(page, node)
    }


def list_attributes(page: Page, node: Node | None) -> dict[str, str]:
    """``li`` items as label -> value: the first child without its colon, and the
    last child."""
    return {
        page.text(item.kids[0]).replace(":", "").lower().strip(): page.text(item.kids[-1])
        for item in _items(page, node)
    }


def pair_attributes(page: Page, node: Node) -> dict[str, str]:
    """``dt``/``dd`` pairs in order; a surplus of either is ignored."""
    names, values = page.inside(node, "dt"), page.inside(node, "dd")
    return {page.text(k).lower().strip(): page.text(v) for k, v in zip(names, values)}


def _article(page: Page) -> dict:
    """Layout A: nested sections 1 header, 2 body, 3 about, 4 keywords (optional)."""
    labelled = (n for n in page.inside(page.root, "section") if dict(n.attrs).get("aria-label") == ARTICLE_LABEL)
    sections = page.inside(_need(next(labelled, None), "article section"), "section")
    if len(sections) < 4:
        raise LayoutError(f"{len(sections)} sections")
    header, body, about = sections[1:4]
    line = page.first(sections[4], "p") if len(sections) > 4 else None
    attributes = {"arbeidsgiver": page.text(_need(page.first(header, "p"), "employer"))}
    attributes |= header_attributes(page, _need(page.first(header, "ul"), "header list"))
    about_list = next(iter(page.children(about, "ul")), None)
    attributes |= list_attributes(page, _need(about_list, "about list"))
    return {
        "article_header": page.text(_need(page.first(header, "h2"), "header")),
        "article_content": page.joined(body).replace(NBSP, ""),
        "about_section_content": page.joined(about).replace(NBSP, ""),
        "keywords": page.text(line) if line else None,
        "section_count": len(sections),
        "attributes": attributes,
    }


def _position(page: Page) -> dict:
    """Layout B: the second block of ``main``; searches run forward in the document."""
    blocks = page.children(_need(page.first(page.root, "main"), "main"), "div")
    if len(blocks) < 2:
        raise LayoutError(f"{len(blocks)} blocks")
    top = _need(page.after(blocks[1], "div"), "top block")
    inner = page.children(blocks[1], "div")
    if len(inner) < 2:
        raise LayoutError(f"{len(inner)} inner blocks")
    attributes = pair_attributes(page, _need(page.after(top, "dl"), "top list"))
    attributes |= pair_attributes(page, _need(page.after(inner[1], "dl"), "bottom list"))
    return {
        "article_header": page.text(_need(page.after(top, "h1"), "header")).replace(NBSP, ""),
        "article_content": page.joined(_need(page.after(top, "section"), "body")).replace(NBSP, ""),
        "attributes": attributes,
    }


def article_record(html: str | None, job_type: str | None) -> dict:
    try:
        if html is None:
            raise LayoutError("no html")
        if job_type in ARTICLE_JOB_TYPES:
            return _article(Page(html))
        if job_type in POSITION_JOB_TYPES:
            return _position(Page(html))
        raise LayoutError(f"unsupported job type: {job_type}")
    except LayoutError as reason:
        return {"error": str(reason)}
    except (AssertionError, ValueError, RecursionError) as fault:  # markup the parser refuses
        return {"error": unreadable(fault)}


def unreadable(fault: Exception) -> str:
    return f"unreadable page: {type(fault).__name__}"


def _from_page(html: str | None, read):
    """``read(page)``; None for no page and for one that cannot be parsed, which costs
    this value and not the job."""
    if html is None:
        return None
    try:
        return read(Page(html))
    except (AssertionError, ValueError, RecursionError):
        return None


_FIELDS = ["article_header", "article_content", "about_section_content", "keywords"]


def _record_frame(records: list[dict]) -> pd.DataFrame:
    columns = {f: pd.Series([r.get(f) for r in records], dtype=object) for f in _FIELDS}
    columns["section_count"] = pd.Series([r.get("section_count") for r in records], dtype="Int32")
    columns["attributes"] = pd.Series([r.get("attributes") for r in records], dtype=object)
    columns["error"] = pd.Series([r.get("error") for r in records], dtype=object)
    return pd.DataFrame(columns)


def extract_content(df: DataFrame, html: str = "html_main", job_type: str = "job_type") -> DataFrame:
    """Add the article columns, the open ``attributes`` map and ``error``."""

    @F.pandas_udf(RECORD_DDL)
    def extract(pages: pd.Series, types: pd.Series) -> pd.DataFrame:
        return _record_frame([article_record(h, t) for h, t in zip(pages, types)])

    # Marked nondeterministic so that a filter on the result is not pushed below
    # it, which would parse every page twice.
    record = extract.asNondeterministic()(F.col(html), F.col(job_type))
    names = [c for c in df.columns]
    parsed = df.select(*names, record.alias("_r"))
    return parsed.select(
        *names,
        *[f"_r.{f}" for f in _FIELDS],
        F.col("_r.section_count").alias("_debug_article_section-counts"),
        "_r.attributes",
        "_r.error",
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col("error").isNull()).drop("error")


def quarantined(df: DataFrame) -> DataFrame:
    kept = ["id", "canonical_url", "job_type", "error", "html_main"]
    return df.where(F.col("error").isNotNull()).select(*kept, *(["html_hash"] if "html_hash" in df.columns else []))


def parse_errors(df: DataFrame, html: str = "html") -> DataFrame:
    """``df`` with ``parse_error``: why a page cannot be read, else NULL."""

    @F.pandas_udf("string")
    def fault(pages: pd.Series) -> pd.Series:
        def one(source):
            try:
                page = Page(source) if source is not None else None
                _ = page and page.joined(page.root)
                return None
            except (AssertionError, ValueError, RecursionError) as error:
                return unreadable(error)

        return pages.map(one).astype(object)

    return df.withColumn("parse_error", fault(F.col(html)))


def main_subtree(df: DataFrame, html: str = "html", tag: str = "main", out: str = "html_main") -> DataFrame:
    """The first ``<main>`` (or another tag) as HTML; NULL when the page has none."""

    @F.pandas_udf("string")
    def subtree(pages: pd.Series) -> pd.Series:
        def one(page):
            node = page.first(page.root, tag)
            return page.markup(node) if node else None

        return pages.map(lambda source: _from_page(source, one)).astype(object)

    return df.withColumn(out, subtree(F.col(html)))


def subtree_text(df: DataFrame, html: str = "html", tag: str = "main", out: str = "text") -> DataFrame:
    """Stripped text pieces of the first such tag, joined by ``|``, without NBSP."""

    @F.pandas_udf("string")
    def text(pages: pd.Series) -> pd.Series:
        def one(page):
            node = page.first(page.root, tag)
            return page.joined(node).replace(NBSP, "") if node else None

        return pages.map(lambda source: _from_page(source, one)).astype(object)

    return df.withColumn(out, text(F.col(html)))


def list_items(df: DataFrame, html: str = "html", out: str = "attributes") -> DataFrame:
    """``li`` items of the page's first ``ul`` as a label -> value map."""

    @F.pandas_udf("map<string,string>")
    def items(pages: pd.Series) -> pd.Series:
        def one(page):
            node = page.first(page.root, "ul")
            return list_attributes(page, node) if node else None

        return pages.map(lambda source: _from_page(source, one)).astype(object)

    return df.withColumn(out, items(F.col(html)))


def with_job_type(df: DataFrame, url: str = "canonical_url") -> DataFrame:
    return df.withColumn("job_type", job_type_of_url(F.col(url)))


def with_ad_type(df: DataFrame, url: str = "canonical_url") -> DataFrame:
    return df.withColumn("ad_type", ad_type_of_url(F.col(url)))
