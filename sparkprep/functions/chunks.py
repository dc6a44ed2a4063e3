"""The overlapping paragraph chunker, as one expression over a document's text."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from sparkprep.functions.bind import bind
from sparkprep.functions.text import WHITESPACE, is_blank, strip

JOINER = "\n\n"

# A fold copies its whole state in each step, so the list of finished chunks must not be
# part of a long fold. Paragraphs are folded in blocks, and the blocks are folded in turn.
BLOCK = 32


def paragraphs(text: Column, separator: str = "\n\n") -> Column:
    """Non-blank paragraphs, unstripped, in order."""
    return F.filter(F.split(text, re.escape(separator)), lambda p: ~is_blank(p))


def _cut(pieces: Column, width: int) -> Column:
    """Cut every string of ``pieces`` into runs of at most ``width`` characters."""
    return F.flatten(
        F.transform(
            pieces,
            lambda p: F.transform(
                F.sequence(F.lit(1), F.length(p), F.lit(width)),
                lambda start: F.substring(p, start, F.lit(width)),
            ),
        )
    )


def _blocks(pieces: Column) -> Column:
    """Cut a list into about as many blocks as a block has entries, of at least BLOCK."""

    def cut(items: Column) -> Column:
        width = F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(F.size(items))).cast("int"))
        return bind(
            width,
            lambda w: F.transform(
                F.sequence(F.lit(0), F.floor((F.size(items) - 1) / w).cast("int")),
                lambda i: F.slice(items, i * w + 1, w),
            ),
        )

    return bind(
        pieces,
        lambda items: F.when(F.size(items) > 0, cut(items)).otherwise(
            F.array().cast("array<array<string>>")
        ),
    )


def chunk_text(
    text: Column,
    chunk_size: int = 1000,
    overlap: int = 200,
    min_length: int = 100,
    separator: str = "\n\n",
    split_long: bool = False,
) -> Column:
    """Array of overlapping chunks of ``text``.

    Paragraphs are gathered until the next one would take the running text past
    ``chunk_size``. Then, if the running text has at least ``min_length`` characters, it
    becomes a chunk and its last ``overlap`` characters start the next one. The blank
    line after each paragraph counts in the running length. A rest shorter than
    ``min_length`` is dropped, so a short text has no chunk.

    A paragraph longer than ``chunk_size`` stays whole and makes a longer chunk. With
    ``split_long`` it is cut first, a chunk never exceeds ``chunk_size``, and
    ``min_length`` applies to the rest only.
    """
    spans = chunk_spans(text, chunk_size, overlap, min_length, separator, split_long)
    return F.transform(spans, lambda s: s["chunk"])


def chunk_spans(
    text: Column,
    chunk_size: int = 1000,
    overlap: int = 200,
    min_length: int = 100,
    separator: str = "\n\n",
    split_long: bool = False,
) -> Column:
    """The chunks of :func:`chunk_text` as ``array<struct<chunk, piece>>``.

    ``piece`` is the number, from 1, of the paragraph with which a chunk's own text begins,
    after what it carries over. With ``split_long`` it numbers the cut paragraphs.
    """
    pieces = paragraphs(text, separator)
    if split_long:
        width = chunk_size - overlap - len(JOINER)
        if width < 1:
            raise ValueError("split_long needs chunk_size > overlap + 2")
        pieces = _cut(pieces, width)

    def finished(running: Column) -> Column:
        return F.rtrim(running, F.lit(WHITESPACE)) if split_long else strip(running)

    no_chunks = F.array().cast("array<struct<chunk:string,piece:int>>")

    def state(chunks: Column, running: Column, size: Column, piece: Column, count: Column) -> Column:
        parts = {"chunks": chunks, "running": running, "size": size, "piece": piece, "count": count}
        return F.struct(*(value.alias(name) for name, value in parts.items()))

    def closed(now: Column) -> Column:
        return F.array(F.struct(finished(now["running"]).alias("chunk"), now["piece"].alias("piece")))

    def add(now: Column, piece: Column) -> Column:
        grown = F.length(piece) + len(JOINER)
        must_close = (now["size"] + F.length(piece) > chunk_size) & (
            now["size"] >= (1 if split_long else min_length)
        )
        chunks, count = F.concat(now["chunks"], closed(now)), now["count"] + 1
        if overlap <= 0:
            carry, carry_size = F.lit(""), F.lit(0)
        else:
            source = finished(now["running"]) if split_long else now["running"]
            carry = F.concat(F.right(source, F.lit(overlap)), F.lit(JOINER))
            source_size = F.length(source) if split_long else now["size"]
            carry_size = F.least(source_size, F.lit(overlap)) + len(JOINER)
        return F.when(
            must_close, state(chunks, F.concat(carry, piece, F.lit(JOINER)), carry_size + grown, count, count)
        ).otherwise(
            state(
                now["chunks"],
                F.concat(now["running"], piece, F.lit(JOINER)),
                now["size"] + grown,
                now["piece"],
                count,
            )
        )

    def add_block(now: Column, block: Column) -> Column:
        """Fold a block into a list of its own and append that list."""
        start = state(no_chunks, *(now[c] for c in ("running", "size", "piece", "count")))
        return bind(
            F.aggregate(block, start, add),
            lambda done: state(
                F.concat(now["chunks"], done["chunks"]), *(done[c] for c in ("running", "size", "piece", "count"))
            ),
        )

    def close(now: Column) -> Column:
        rest = F.when(now["size"] >= min_length, closed(now)).otherwise(no_chunks)
        return F.concat(now["chunks"], rest)

    empty = state(no_chunks, F.lit(""), F.lit(0), F.lit(1), F.lit(0))
    return F.aggregate(_blocks(pieces), empty, add_block, close)
