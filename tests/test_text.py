from pyspark.sql import functions as F

from sparkprep.functions import text as T
from sparkprep.functions.hashing import fraction, pick, row_key

SAMPLES = [
    "  The quick fox.  Jumps over ",
    "\t An  apple\na day. Keeps",
    "theory of everything",
    "the",
    "",
    " \n\t ",
    "no stop \x1c here　now",
    "a b c d e f g h i j k l m",
    ". starts with a stop",
    "In Berlin wächst das Gras. Ja.",
]


def evaluate(spark, *columns):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, t string")
    return [tuple(r) for r in df.orderBy("i").select(*columns).collect()]


def test_whitespace_follows_python(spark):
    t = F.col("t")
    rows = evaluate(spark, T.strip(t), T.words(t), T.is_blank(t), T.collapse(t))
    for text, (stripped, words, blank, collapsed) in zip(SAMPLES, rows):
        assert stripped == text.strip()
        assert words == text.split()
        assert blank == (not text.strip())
        assert collapsed == " ".join(text.split())


def test_whitespace_list_is_complete():
    spaces = {chr(c) for c in range(0x110000) if chr(c).isspace()}
    assert set(T.WHITESPACE) == spaces


def test_subjects(spark):
    t = F.col("t")
    rows = evaluate(spark, T.first_sentence(t), T.drop_leading_stopword(T.first_sentence(t)), T.keywords(t))
    assert [r[0] for r in rows] == [
        "The quick fox", "An  apple\na day", "theory of everything", "the", "", "", "no stop \x1c here\u3000now",
        "a b c d e f g h i j k l m", "", "In\u00a0Berlin wächst das Gras",
    ]
    assert [r[1] for r in rows] == [
        "quick fox", "apple a day", "theory of everything", "", "", "", "no stop \x1c here\u3000now",
        "b c d e f g h i j k l m", "", "Berlin wächst das Gras",
    ]
    assert [r[2] for r in rows] == [
        "The quick fox. Jumps over", "An apple a day. Keeps", "theory of everything", "the", "", "", "no stop here now",
        "a b c d e f g h i j", ". starts with a stop", "In Berlin wächst das Gras. Ja.",
    ]


def test_clean_text(spark):
    dirty = "  a\u00a0\t b\x07c \r\n\r\n \n\n d\re\x7f \n"
    assert spark.range(1).select(T.clean_text(F.lit(dirty))).first()[0] == "a bc\n\nd\ne"
    assert spark.range(1).select(T.clean_text(F.lit(None).cast("string"))).first()[0] is None


def test_templates_are_filled_by_key(spark):
    key = row_key("i")
    rows = evaluate(spark, pick(key, 5), T.question(F.col("t"), key), T.instruction(F.col("t"), key))
    assert len({r[0] for r in rows}) > 1
    for text, (choice, question, instruction) in zip(SAMPLES, rows):
        head, tail = T.QUESTION_TEMPLATES[choice].split("{}")
        assert question.startswith(head) and question.endswith(tail)
        assert instruction == T.INSTRUCTION_TEMPLATES[choice].replace("{}", " ".join(text.split()[:10]))


def test_hashes_are_uniform(spark):
    keys = spark.range(5000).select(row_key("id").alias("k"))
    row = keys.select(F.avg(fraction(F.col("k"))), F.avg(pick(F.col("k"), 5))).first()
    assert abs(row[0] - 0.5) < 0.02 and abs(row[1] - 2.0) < 0.1


def test_prompts_and_answers(spark):
    one = spark.range(1).select(
        T.training_prompt(F.lit("a"), F.lit("b")).alias("p"),
        T.qa_prompt(F.lit("why")).alias("q"),
        T.answer_of(F.lit("Question: x\nAnswer: y Answer: z \n")).alias("last"),
        T.answer_of(F.lit("  plain ")).alias("plain"),
        T.prediction_content(F.lit('{"content": "c"}')).alias("content"),
        T.prediction_content(F.lit('{"other": 1}')).alias("other"),
        T.prediction_content(F.lit("text")).alias("text"),
        T.context_preview(F.lit("x" * 300), 10).alias("cut"),
    ).first()
    assert one.p == "Input: a\nOutput: b" and one.q == "Question: why\nAnswer:"
    assert (one["last"], one.plain, one.content) == ("z", "plain", "c")
    assert (one.other, one.text, one.cut) == ('{"other": 1}', "text", "x" * 10 + "...")
