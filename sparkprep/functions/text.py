"""String expressions: trimming, words, templates, prompts and answers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sparkprep.functions.bind import bind
from sparkprep.functions.hashing import pick

# The characters that count as white space in text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_CLASS = (
    r"\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WHITESPACE_RUN = f"[{_CLASS}]+"
NOT_WHITESPACE = f"[^{_CLASS}]"

# Words dropped from the start of a sentence.
LEADING_STOPWORDS = ("the", "a", "an", "in", "on", "at", "to", "for", "with", "by")

# Question and instruction templates; {} takes the subject.
QUESTION_TEMPLATES = (
    "What can you tell me about {}?",
    "Explain {} in detail.",
    "Describe {}.",
    "What is {}?",
    "Can you provide information about {}?",
)
INSTRUCTION_TEMPLATES = (
    "Summarize the following information about {}...",
    "Explain the concept of {} based on the following text...",
    "Based on the documentation, describe {}...",
    "Using the following information, explain {}...",
    "Provide a detailed explanation of {} from the documentation...",
)

KEYWORD_COUNT = 10


def strip(text: Column) -> Column:
    """Drop white space, tabs and line breaks included, from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def clean_text(text: Column) -> Column:
    """Text ready for chunking: no control characters, single blanks, at most one empty line in a row.

    Line ends become line feeds, tabs and no-break spaces blanks; blanks beside a line end and
    white space at both ends go. Unicode forms are left to the caller.
    """
    steps = [("\r\n?", "\n"), ("[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", ""), ("[ \t\u00A0]+", " "), (" ?\n ?", "\n"), ("\n{3,}", "\n\n")]
    for pattern, new in steps:
        text = F.regexp_replace(text, pattern, new)
    return strip(text)


def is_blank(text: Column) -> Column:
    """True if there is nothing but white space."""
    return ~text.rlike(NOT_WHITESPACE)


def collapse(text: Column) -> Column:
    """The words of ``text`` with one blank between them."""
    return F.trim(F.regexp_replace(text, WHITESPACE_RUN, " "))


def words(text: Column) -> Column:
    """White-space separated words; blank text has none.

    Runs are replaced first: a constant pattern is compiled once there, but for each row
    in ``split``, which is quick only for a single plain character.
    """
    return F.array_remove(F.split(collapse(text), " "), "")


def first_sentence(text: Column) -> Column:
    """Text before the first full stop."""
    return strip(F.substring_index(text, ".", 1))


def drop_leading_stopword(sentence: Column) -> Column:
    """Drop the first word of a stripped sentence if it is a stopword.

    Only then are the remaining words joined anew.
    """
    head = F.regexp_extract(sentence, f"^{NOT_WHITESPACE}+", 0)
    rest = F.substring(sentence, F.length(head) + 1, F.length(sentence))
    return F.when(F.lower(head).isin(*LEADING_STOPWORDS), collapse(rest)).otherwise(sentence)


def keywords(text: Column, count: int = KEYWORD_COUNT) -> Column:
    """The first ``count`` words, joined by one blank."""
    first = f"^(?:{NOT_WHITESPACE}+{WHITESPACE_RUN}){{0,{count - 1}}}{NOT_WHITESPACE}+"
    return collapse(F.regexp_extract(strip(text), first, 0))


def fill_template(templates: tuple[str, ...], subject: Column, key: Column) -> Column:
    """Put ``subject`` into the template that the hash ``key`` picks."""
    heads, tails = zip(*(t.split("{}") for t in templates))
    position = pick(key, len(templates)) + 1
    return F.concat(
        F.element_at(F.array(*map(F.lit, heads)), position),
        subject,
        F.element_at(F.array(*map(F.lit, tails)), position),
    )


def question(chunk: Column, key: Column) -> Column:
    """A question about the first sentence of ``chunk``."""
    subject = bind(first_sentence(chunk), drop_leading_stopword)
    return fill_template(QUESTION_TEMPLATES, subject, key)


def instruction(chunk: Column, key: Column) -> Column:
    """An instruction about the first words of ``chunk``."""
    return fill_template(INSTRUCTION_TEMPLATES, keywords(chunk), key)


def training_prompt(input_text: Column, output_text: Column) -> Column:
    """The text a model is trained on."""
    return F.concat(F.lit("Input: "), input_text, F.lit("\nOutput: "), output_text)


def qa_prompt(question_text: Column) -> Column:
    """The text a model is asked to continue."""
    return F.concat(F.lit("Question: "), question_text, F.lit("\nAnswer:"))


def answer_of(response: Column) -> Column:
    """The part of a model response after the last ``Answer:``; all of it without one."""
    return strip(F.substring_index(response, "Answer:", -1))


def prediction_content(prediction: Column) -> Column:
    """Field ``content`` of a JSON prediction, else the prediction itself."""
    return F.coalesce(F.get_json_object(prediction, "$.content"), prediction)


def context_preview(chunk: Column, length: int = 200) -> Column:
    """The start of a chunk, marked as cut when it is longer."""
    return F.when(
        F.length(chunk) > length, F.concat(F.left(chunk, F.lit(length)), F.lit("..."))
    ).otherwise(chunk)
