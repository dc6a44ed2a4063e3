"""Pages, metadata, headings and sections of documents.

A document travels as one row whose ``pages`` column is an
``array<struct<page_no int, text string>>``, the way a parser emits it. Everything below
is worked out inside that row: no shuffle, and no document waits for another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.functions.bind import bind
from sparkprep.functions.chunks import chunk_spans, paragraphs
from sparkprep.functions.text import strip
from sparkprep.operators.asof import asof_join

METADATA_FIELDS = (
    "title",
    "author",
    "subject",
    "creator",
    "producer",
    "creation_date",
    "modification_date",
)

# A heading is a short line that starts with a capital letter or a number and does not
# close like a sentence.
HEADING = r"^\s*(\p{Lu}|\d+(\.\d+)*[.)]?\s)[^\n]{1,60}[^\n.,;:!?\s]\s*$"


def pages_of(text: Column, separator: str = "\n") -> Column:
    """Cut a text into numbered pages."""
    return F.transform(
        F.split(text, separator),
        lambda line, i: F.struct((i + 1).alias("page_no"), line.alias("text")),
    )


def assemble_pages(pages: Column) -> Column:
    """Page texts in order, empty pages left out, a blank line between pages."""
    texts = F.transform(pages, lambda p: p["text"])
    return F.array_join(F.filter(texts, lambda t: t.isNotNull() & (t != "")), "\n\n")


def normalize_metadata(documents: DataFrame, pages: str = "pages") -> DataFrame:
    """Metadata fields as strings, empty where missing, and the page count.

    Fields the table lacks are added.
    """
    present = set(documents.columns)
    fields = [
        (F.coalesce(F.col(name).cast("string"), F.lit("")) if name in present else F.lit("")).alias(
            name
        )
        for name in METADATA_FIELDS
    ]
    others = [c for c in documents.columns if c not in METADATA_FIELDS and c != pages]
    return documents.select(
        *others, *fields, F.coalesce(F.size(pages), F.lit(0)).alias("pages")
    )


def entity_spans(text: Column, entities: Column) -> Column:
    """Give each entity its text, cut from ``text`` by ``[start_index, end_index)``."""
    return F.transform(
        entities,
        lambda e: F.struct(
            e["type"].alias("type"),
            F.substring(text, e["start_index"] + 1, e["end_index"] - e["start_index"]).alias(
                "text"
            ),
            e["confidence"].alias("confidence"),
        ),
    )


def headings(pages: Column, pattern: str = HEADING) -> Column:
    """Pages whose text matches the heading pattern, in page order."""
    return F.filter(pages, lambda p: p["text"].rlike(pattern))


def toc(pages: Column, pattern: str = HEADING) -> Column:
    """Heading titles in page order; empty if there are none."""
    return F.transform(headings(pages, pattern), lambda h: strip(h["text"]))


def sections(pages: Column, pattern: str = HEADING) -> Column:
    """``array<struct<title, start_page, end_page>>``; ``end_page`` is null for the last."""
    return bind(
        headings(pages, pattern),
        lambda found: F.transform(
            found,
            lambda h, i: F.struct(
                strip(h["text"]).alias("title"),
                h["page_no"].alias("start_page"),
                (F.get(found, i + 1)["page_no"] - 1).alias("end_page"),
            ),
        ),
    )


def section_chunks(
    documents: DataFrame, pattern: str = HEADING, doc_id: str = "doc_id", pages: str = "pages"
) -> DataFrame:
    """Assign each page to its section: ``doc_id, section_no, title, page_no, text``.

    Sections are consecutive, so each is a slice of the page list; a range join would
    compare every page with every section. Pages before the first heading get section 0
    without a title. Page numbers must count from 1 without gaps.
    """

    def with_preface(found: Column) -> Column:
        first = F.coalesce(F.get(found, F.lit(0))["start_page"], F.lit(2**31 - 1))
        preface = F.struct(
            F.lit(None).cast("string").alias("title"),
            F.lit(1).alias("start_page"),
            (first - 1).alias("end_page"),
        )
        return F.concat(F.array(preface), found)

    def body(section: Column, number: Column, whole: Column) -> Column:
        last = F.least(F.coalesce(section["end_page"], F.size(whole)), F.size(whole))
        return F.transform(
            F.slice(
                whole, section["start_page"], F.greatest(last - section["start_page"] + 1, F.lit(0))
            ),
            lambda p: F.struct(
                number.alias("section_no"),
                section["title"].alias("title"),
                p["page_no"].alias("page_no"),
                p["text"].alias("text"),
            ),
        )

    rows = bind(
        F.col(pages),
        lambda whole: F.flatten(
            F.transform(with_preface(sections(whole, pattern)), lambda s, i: body(s, i, whole))
        ),
    )
    return documents.select(doc_id, F.inline(rows))


def chunk_sections(
    documents: DataFrame, pattern: str = HEADING, doc_id: str = "doc_id", pages: str = "pages", separator: str = "\n\n", **chunking
) -> DataFrame:
    """Assign each chunk of a document to a section: ``doc_id, chunk_index, section_no, title``.

    The document's text is its pages' texts joined by ``separator``, its chunks are those of
    :func:`chunk_spans` (``chunking``: its sizes). A chunk belongs to the section of the page
    on which its own text begins; before the first heading that is section 0 without a
    title. All of it happens inside the row.
    """
    rows = documents.select(
        doc_id,
        sections(F.col(pages), pattern).alias("_sections"),
        _owners(pages, separator).alias("_owners"),
        F.posexplode(chunk_spans(_paged_text(pages, separator), separator=separator, **chunking)).alias("_i", "_chunk"),
    )
    page = F.get("_owners", F.col("_chunk")["piece"] - 1)
    number = F.size(F.filter("_sections", lambda s: s["start_page"] <= page))
    title = F.get("_sections", number - 1)["title"].alias("title")
    return rows.select(doc_id, (F.col("_i") + 1).alias("chunk_index"), number.alias("section_no"), title)


def _paged_text(pages: str, separator: str) -> Column:
    return F.array_join(F.transform(pages, lambda p: F.coalesce(p["text"], F.lit(""))), separator)


def _owners(pages: str, separator: str) -> Column:
    """The page of each paragraph of a document."""
    return F.flatten(
        F.transform(pages, lambda p: F.array_repeat(p["page_no"], F.size(F.coalesce(paragraphs(p["text"], separator), F.array()))))
    )


def chunk_pages(documents: DataFrame, doc_id: str = "doc_id", pages: str = "pages", separator: str = "\n\n", **chunking) -> DataFrame:
    """``doc_id, chunk_index, page_no`` of each chunk: the page on which its own text begins."""
    rows = documents.select(
        doc_id,
        _owners(pages, separator).alias("_owners"),
        F.posexplode(chunk_spans(_paged_text(pages, separator), separator=separator, **chunking)).alias("_i", "_chunk"),
    )
    page = F.get("_owners", F.col("_chunk")["piece"] - 1)
    return rows.select(doc_id, (F.col("_i") + 1).alias("chunk_index"), page.alias("page_no"))


def section_table(documents: DataFrame, pattern: str = HEADING, doc_id: str = "doc_id", pages: str = "pages") -> DataFrame:
    """``doc_id, section_no, title, start_page, end_page``: a row per section, numbered from 1."""
    found = documents.select(doc_id, F.posexplode(sections(F.col(pages), pattern)).alias("_i", "_s"))
    return found.select(doc_id, (F.col("_i") + 1).alias("section_no"), "_s.*")


def assign_sections(chunks: DataFrame, section_rows: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows of a chunk table (``doc_id, page_no``, …) with ``section_no, title`` from a table of sections.

    The two tables may come from anywhere and be of any size: a chunk gets the last section of its
    document that starts on its page or before, by :func:`asof_join`. Before the first section, and
    without a page, that is section 0 without a title.
    """
    found = asof_join(chunks, section_rows, [doc_id], "page_no", "start_page", ["section_no", "title"])
    return found.withColumn("section_no", F.coalesce("section_no", F.lit(0)))


def document_structure(
    documents: DataFrame, pattern: str = HEADING, doc_id: str = "doc_id", pages: str = "pages"
) -> DataFrame:
    """``doc_id, metadata, toc, sections`` per document."""
    described = normalize_metadata(documents.withColumn("_pages", F.col(pages)), pages)
    return described.select(
        doc_id,
        F.struct(*METADATA_FIELDS, "pages").alias("metadata"),
        toc(F.col("_pages"), pattern).alias("toc"),
        sections(F.col("_pages"), pattern).alias("sections"),
    )
