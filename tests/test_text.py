import random
import re

import pytest
from pyspark.sql import functions as F

from threadlens.functions import fixed
from threadlens.functions import text as tx
from threadlens.functions.flags import check_registry, flag_columns, priority_label

PIECES = [
    "https://a.example/x?y=1", "WWW.Site.RU", "x.y+z@mail.example.com", "/usr/lib/a.so", r"C:\tmp\b.txt", "a/b",
    "550e8400-e29b-41d4-a716-446655440000", "deadbeefdeadbeef00", "2024-01-05 10:11", "2024/01/05", "12345", "999",
    "```", "{json: [1]}", "Привет", "ещё", "éclair", "from", "WITH", "naïve_word", "c++", "-dash-", "...", "Ⅷ", "٣٤٥٦",
    "\x1c", "\u2003", "\u00a0", "\r\n", "\t", "  ", "=", "|", "the", "please",
]


def random_texts(n=400):
    rng = random.Random(7)
    return ["".join(rng.choice(PIECES) + rng.choice([" ", "", " ", ","]) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def evaluate(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def python_masks(text):
    for word, pattern in fixed.MASKS:
        flags = re.IGNORECASE if pattern.startswith("(?iU)") else 0
        text = re.sub(re.sub(r"^\(\?i?U\)", "", pattern), f" {word} ", text, flags=flags)
    return text


def squeeze(text):
    return " ".join(text.split())


def test_cleaning_collapses_every_kind_of_whitespace(spark):
    texts = random_texts()
    assert evaluate(spark, texts, tx.clean_text(F.col("t"))) == [squeeze(t) for t in texts]
    assert evaluate(spark, texts, tx.strip_text(F.col("t"))) == [t.strip() for t in texts]


def test_word_count(spark):
    texts = random_texts(100)
    assert evaluate(spark, texts, tx.word_count(tx.clean_text(F.col("t")))) == [len(t.split()) for t in texts]


def test_masks_match_unicode_regular_expressions(spark):
    texts = [squeeze(t).lower() for t in random_texts()]
    assert evaluate(spark, texts, tx.mask_entities(F.col("t"))) == [python_masks(t) for t in texts]


def test_modeling_text(spark):
    noisy = "Order <98765> of 0b6f1c2e-7a43-4c55-9d10-2f6e8a7b4c33: see [/srv/shop/log.txt], or mail it@shop.example on 2031-07-08!"
    got = evaluate(spark, [noisy, "12 3", "", "the and for", "Жёлтый, ещё"], tx.modeling_text(tx.clean_text(F.col("t"))))
    assert got == [
        "order num of uuid see path or mail email on date", "empty", "empty", "the and for", "лтый ещ",
    ]


def test_modeling_text_caps_and_switches(spark):
    clean = tx.clean_text(F.col("t"))
    texts = ["one the two three four"]
    assert evaluate(spark, texts, tx.modeling_text(clean, max_tokens=3)) == ["one two three"]
    assert evaluate(spark, texts, tx.modeling_text(clean, max_tokens=None)) == ["one two three four"]
    assert evaluate(spark, texts, tx.modeling_text(clean, strip_stopwords=False)) == ["one the two three four"]
    assert evaluate(spark, ["The  A"], tx.modeling_text(clean, enabled=False)) == ["the a"]
    assert evaluate(spark, ["the and for"], tx.modeling_text(clean, max_tokens=0)) == ["the"]


def test_ngrams(spark):
    got = evaluate(spark, ["A b, c", "x", ""], tx.ngrams(F.col("t"), 1, 3))
    assert got == [["a", "b", "c", "a b", "b c", "a b c"], ["x"], []]
    assert evaluate(spark, ["a b c"], tx.ngrams(F.col("t"), 2, 2)) == [["a b", "b c"]]


def test_titles(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b", "c", "d"], " \t", "auto"), (2, [], None, None), (3, ["x"], "LLM", "auto")],
        "topic_id int, k array<string>, llm string, auto string",
    )
    rows = df.select(
        tx.auto_title(F.col("k"), F.lit("none")).alias("a"),
        tx.display_title(F.col("llm"), F.col("auto"), F.col("topic_id")).alias("d"),
    ).collect()
    assert [tuple(r) for r in rows] == [("a, b, c", "auto"), ("none", "topic_2"), ("x", "LLM")]


@pytest.mark.parametrize(("limit", "strip", "expected"), [(5, True, "ab cd"), (None, True, "ab cdefghi"), (3, False, "ab\0")])
def test_embedding_input(spark, limit, strip, expected):
    assert evaluate(spark, ["ab\0cdefghi"], tx.embedding_input(F.col("t"), limit, strip)) == [expected]


def test_embedding_key_depends_on_the_prepared_text(spark):
    key = lambda t: tx.embedding_key(tx.embedding_input(t, 4, True), "p", "m", 4)
    first, second, third = evaluate(spark, ["abcdef", "abcdZZ", "abcX"], key(F.col("t")))
    assert first == second != third


def test_domain_flags(spark):
    texts = [
        "An SQL view of the harvest: select kind from apples", "The script ends in a traceback, see https://orchard.example/7",
        "Put the jira epic and the confluence page into a docx", "éfrom", "ОШИБК", "nothing here",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    flagged = df.select("i", *[c.alias(n) for n, c in flag_columns(F.col("t")).items()])
    rows = flagged.select("*", priority_label(flagged.columns).alias("label")).orderBy("i").collect()
    hits = [{n for n in fixed.DOMAIN_FLAGS if r[n]} for r in rows]
    assert hits[0] == {"has_sql", "has_code"}
    assert {"has_link", "has_error_terms", "has_code"} <= hits[1]
    assert {"has_document_terms", "has_jira_terms", "has_confluence_terms"} <= hits[2]
    assert hits[3] == set() and hits[5] == set()
    assert hits[4] == set()  # the pattern wants an ending after the stem
    assert [r.label for r in rows][:3] == ["sql", "code", "jira"] and rows[5].label == "general"


def test_flags_equal_python_search(spark):
    texts = random_texts() + ["SELECT a FROM b", "router x model", "Fallbacks", "сводная", "open WebUI", "1С"]
    texts += ["\u017felect", "DELETE FROM", "Wi\u212ai", "\u212anowledge base", "I\u017f\u017fue", "ßelect", "\u0130ssue", "w\u0131k\u0131", "\u1c83водная", "ОШИБКА", "Конфигурация 1С"]
    texts += [needle.upper() + "а" for needles in fixed.FLAG_NEEDLES.values() for needle in needles]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", *[c.alias(n) for n, c in flag_columns(F.col("t")).items()]).orderBy("i").collect()
    for name, pattern in fixed.DOMAIN_FLAGS.items():
        assert [r[name] for r in rows] == [bool(re.search(pattern, t, re.IGNORECASE)) for t in texts], name


def test_registry_check():
    check_registry({"a": "x", "b": "y"}, ["a"])
    with pytest.raises(ValueError, match=r"\['b', 'c'\]"):
        check_registry({"a": "x"}, ["c", "a", "b"])
