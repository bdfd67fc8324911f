"""Column functions on hand-written strings; expectations follow from the rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pressmill.functions import cleaning, metadata as meta
from pressmill.functions.blanks import BLANK_CHARS, squeeze, strip
from pressmill.functions.prediction import head_words, prediction_columns, softmax_pair
from pressmill.functions.rounding import round1_exact, round1_scaled
from pressmill.operators.cleaning import with_clean_text


def apply(spark, function, values, kind="string"):
    rows = [(i, value) for i, value in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r[1] for r in df.select("i", function(F.col("x"))).orderBy("i").collect()]


def check(spark, function, cases):
    got = apply(spark, function, [text for text, _ in cases])
    assert got == [want for _, want in cases]
    if function is cleaning.clean_text:
        rows = [(i, text) for i, (text, _) in enumerate(cases)]
        df = with_clean_text(spark.createDataFrame(rows, "i int, text string"))
        assert [r.text for r in df.orderBy("i").collect()] == got


NBSP, THIN, LS = "\xa0", chr(0x2009), chr(0x2028)


def test_blanks(spark):
    everything = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert sorted(BLANK_CHARS) == everything
    noise = [f"{a}x{b}{b}y{a}" for a, b in zip(everything, reversed(everything))]
    assert apply(spark, squeeze, noise) == ["x y"] * len(noise)
    assert apply(spark, strip, noise) == [n.strip() for n in noise]


def test_delimiters_and_headers(spark):
    check(spark, cleaning.clean_text, [
        ("<***>NASLOV: x", "NASLOV: x"),
        ("<***>\nNASLOV: x", ""),
        ("NASLOV: abc\rdef\nrest", "rest"),
        (f"NASLOV: abc{LS}def\nrest", "rest"),
        (" NASLOV: x", "NASLOV: x"),
        ("NASLOV\n: x\ny", "y"),
        ("autor: q", "autor: q"),
        ("AUTOR(I) : N/A\nAUTORI: a\nx NASLOV: y", "x NASLOV: y"),
        ("a <***> b", "a b"),
        (None, ""),
        ("", ""),
    ])


def test_html(spark):
    check(spark, cleaning.clean_text, [
        ("a&nbsp;b", "a b"),
        ("a&#160;b &Amp; c", "a&#160;b &Amp; c"),
        ("a<b i c>d", "a d"),
        ("1 < 2", "1 < 2"),
        ("<p\nclass='x'>t</p>", "t"),
        ("<a href='&amp;'>x</a>&lt;&gt;", "x"),
        ("&<b>amp;", "& amp;"),
        ("<&lt;>x", "x"),
        ("<>x>y", "<>x>y"),
    ])


def test_one_pass_equals_two(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("<>&;ab ") for _ in range(12)) for _ in range(400)]
    both = apply(spark, lambda c: F.regexp_replace(c, cleaning._TAG_OR_ENTITY, " "), texts)
    assert both == apply(spark, lambda c: cleaning.drop_entities(cleaning.drop_tags(c)), texts)


def test_staged_cleaning_equals_the_column(spark):
    rng = random.Random(4)
    parts = ["<***>", "NASLOV: x", "\n", " ", "  ", NBSP, LS, "<b>", "&amp;", "(", "- ", "FENA",
             "AP", ")", ".", "tekst", "č", "<", ">", "\r", "AUTOR(I) :", "—"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    staged = [r.text for r in with_clean_text(df).orderBy("i").collect()]
    assert staged == apply(spark, cleaning.clean_text, texts)
    kept = with_clean_text(df, "text", "seen").orderBy("i").collect()
    assert [r.text for r in kept] == texts and [r.seen for r in kept] == staged


def test_byline(spark):
    check(spark, cleaning.clean_text, [
        ("tekst (FENA)", "tekst"),
        ("tekst — SRNA.", "tekst"),
        ("tekst (AP) i (FENA)", "tekst (AP) i"),
        ("tekst (APELACIJA) kraj", "tekst (APELACIJA) kraj"),
        ("tekst - Avaz piše da je", "tekst"),
        ("visoko-APstraktno i još mnogo toga", "visoko"),
        (f"tekst{NBSP}({THIN}Tanjug{NBSP}){LS}", "tekst"),
        ("tekst (FENA)\n", "tekst"),
        ("tekst (fena)", "tekst (fena)"),
        ("(HINA) tekst", "(HINA) tekst"),
    ])
    bounded = apply(
        spark, lambda c: cleaning.clean_text(c, byline_max_chars=5),
        ["tekst (FENA)", "visoko-APstraktno i još mnogo toga"],
    )
    assert bounded == ["tekst", "visoko-APstraktno i još mnogo toga"]


def test_letters_are_kept(spark):
    check(spark, cleaning.clean_text, [
        ("čćžšđ ČĆŽŠĐ", "čćžšđ ČĆŽŠĐ"),
        ("Ћирилица İı 😀", "Ћирилица İı 😀"),
    ])
    assert apply(spark, F.length, ["čđ😀"]) == [3]


def test_metadata(spark):
    check(spark, meta.source_slug, [
        ("Dnevni Avaz", "dnevni_avaz"), (" ČĆŽŠĐ ", "cczsd"), ("...", "unknown"),
        ("", "unknown"), (f"{NBSP}Buna!{NBSP}", "buna"),
    ])
    check(spark, meta.year_of, [
        ("06.05.2025", 2025), ("", None), ("11902005", 1902), ("1875", None), (None, None),
        ("5. 2010. i 2011", 2010),
    ])
    check(spark, meta.blank_if_unavailable, [
        ("N/A", ""), ("NA", ""), ("-", ""), ("n/a", ""), ("", ""), ("N/a", "N/a"), (None, None),
    ])
    check(spark, meta.as_int, [("1", 1), ("2005.0", 2005), ("x", None), (None, None)])


def test_source_and_author_fall_back_differently(spark):
    df = spark.createDataFrame([("", "P"), ("N", "P"), (None, "P"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(meta.source_name(F.col("a"), F.col("b"))).collect()] == [
        "P", "N", "P", ""]
    assert [r[0] for r in df.select(meta.first_present(F.col("a"), F.col("b"))).collect()] == [
        "", "N", "P", ""]


@pytest.mark.parametrize("path, label", [
    ("a/avaz_human.txt", 0), ("a/avaz_ai.txt", 1), ("a/avaz.txt", None), ("a/gpt_human.txt", 1),
    ("a/ai-x.txt", 1), ("a/original.txt", 0), ("a_ai/avaz.txt", None), ("a/avaiz.txt", None),
    ("a/x_ai.v2.txt", 1), ("a/x_aič.txt", None), ("a/Ljudski.txt", 0), ("a/ai", 1), ("a/.ai", None),
])
def test_label_from_file_name(spark, path, label):
    assert apply(spark, lambda c: meta.label_from_stem(meta.stem_of(c)), [path]) == [label]


def test_paths(spark):
    check(spark, meta.decoded_path, [
        ("file:/x/Karikature%20i%20stripovi/a+b.txt", "file:/x/Karikature i stripovi/a+b.txt"),
        ("file:/x/100%25/Društvo.txt", "file:/x/100%/Društvo.txt"),
    ])


def test_head_words(spark):
    assert apply(spark, lambda c: head_words(c, 2), ["a b c", "a", ""]) == ["a b", "a", ""]


def test_predictions(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 3.0), (2000.0, -2000.0)], "h double, a double")
    h, a = softmax_pair(F.col("h"), F.col("a"))
    pairs = df.select(h.alias("ph"), a.alias("pa"))
    columns = prediction_columns(F.col("ph"), F.col("pa"))
    rows = pairs.select(*(c.alias(n) for n, c in columns.items())).collect()
    assert [r.pred_label for r in rows] == [0, 1, 0]
    assert rows[0].pred_label_name == "Human-written" and rows[0].confidence == 0.5
    assert rows[1].pred_label_name == "AI-generated/rewritten"
    assert (rows[2].prob_human, rows[2].prob_ai) == (1.0, 0.0)
    assert all(abs(r.prob_human + r.prob_ai - 1) < 1e-15 for r in rows)


def test_rounding_of_shares_is_exact(spark):
    """For every share of up to 250 rows, both ways of computing it."""
    shares = [(a, n) for n in range(1, 251) for a in range(n + 1)]
    df = spark.createDataFrame(shares, "a long, n long")
    a, n = F.col("a").cast("double"), F.col("n").cast("double")
    rows = df.select(
        "a", "n", round1_exact(a * 100 / n).alias("x"), round1_exact((1 - a / n) * 100).alias("y")
    ).collect()
    wrong = [
        r for r in rows
        if r.x != round(100 * r.a / r.n, 1) or r.y != round(100 * (1 - r.a / r.n), 1)
    ]
    assert not wrong


def test_rounding_of_means(spark):
    numpy = pytest.importorskip("numpy")
    rng = random.Random(1)
    values = [rng.random() * 100 for _ in range(2000)] + [k / 20 for k in range(2001)]
    got = apply(spark, round1_scaled, values, "double")
    assert got == [float(numpy.round(numpy.float64(v), 1)) for v in values]
    exact = apply(spark, round1_exact, values, "double")
    assert exact == [round(v, 1) for v in values]


def test_patterns_need_no_engine_flags():
    """Patterns carry their flags, so a session setting cannot change them."""
    assert cleaning.HEADER_LINE.startswith("(?md)")
    assert not re.search(r"(?<!\\)\\w", cleaning.HEADER_LINE)
