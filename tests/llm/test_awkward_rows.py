"""Rows that earlier versions lost, aborted on or took too long for."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from cartwheel.llm import extract, language, minhash, passages, pii

STOP_WORDS = frozenset("the of this is to be and it has that for in".split())
BODY = " ".join(["The first block of this article is long enough to be judged, and it has the common words that the rules look for in it."] * 2)


def prose(seed: int, count: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghij", k=7)) for _ in range(count))


def test_html_copyright_sign_inside_an_article():
    photo = "Photo © Jane Doe for the paper"
    assert extract.main_text(f"<article><p>{BODY}</p><p>{photo}</p><p>© is a sign</p></article><p>© 2024 Site</p>", STOP_WORDS) == f"{BODY} {photo} © is a sign"
    assert extract.main_text(f"<p>{BODY}</p><p>© 2024 Site</p>", STOP_WORDS) == BODY


def test_html_of_a_megabyte_of_broken_markup():
    for unit in ("<a ", "<a '", "<!", "<svg>", "<div class=nav>x ", "<b><p></i>", "<p x='", '<a "y\' ', "<li><b>"):
        begun = time.monotonic()
        extract.main_text(unit * (1_000_000 // len(unit)), STOP_WORDS)
        assert time.monotonic() - begun < 30, unit


def test_html_tags_end_at_the_first_close_outside_quotes():
    assert extract.main_text(f"<article><p title='a>b' x=\"c'>d\">{BODY}</p></article>", STOP_WORDS) == BODY
    assert extract.main_text(f"<article><p>{BODY} 1 < 2</p></article>", STOP_WORDS) == f"{BODY} 1 < 2"


def test_html_with_clashing_columns(spark):
    rows = [(1, "u", f"<article><p>{BODY}</p></article>", "t", 5)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int")
    assert [tuple(r) for r in extract.extract_text(pages).collect()] == [(1, "u", BODY, len(BODY))]
    assert extract.extract_text(pages.limit(0)).collect() == []


def test_passages_that_differ_in_a_symbol_stay(spark):
    rows = [(1, "x = y + z\nif a > b: c\nHello  there, WORLD"), (2, "x = y - z\nif a < b: c\nhello there, world"), (3, "X = Y + Z")]
    got = {r.doc_id: r.text for r in passages.drop_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: rows[0][1], 2: "x = y - z\nif a < b: c\n", 3: ""}


def test_passages_of_rows_without_an_id_are_kept_once(spark):
    line, other = prose(1, 12), prose(2, 12)
    rows = [(None, line)] * 3 + [(None, f"{other}\n{line}"), (None, None), (2**63 - 1, other), (None, "")]
    table = spark.createDataFrame([(i, t, True, 1) for i, t in rows], "doc_id bigint, text string, late boolean, rank int")
    for order in (table, table.orderBy(F.desc("text")), table.repartition(5)):
        got = passages.drop_repeats(order).collect()
        kept = [r.text for r in got if r.doc_id is None]
        assert len(got) == len(rows) and kept.count(None) == 1
        assert sum((t or "").count(line) for t in kept) == 1 and not any(other in (t or "") for t in kept)
        assert [r.text for r in got if r.doc_id is not None] == [other]


def test_passages_equal_brute_force(spark):
    draw = random.Random(3)
    pool = [prose(10 + i, draw.randint(1, 14)) for i in range(40)]
    rows = []
    for i in range(150):
        parts = [draw.choice(pool) if draw.random() < 0.6 else prose(1000 + 50 * i + k, draw.randint(1, 12)) for k in range(draw.randint(0, 9))]
        rows.append((draw.randint(0, 120), "".join(p + draw.choice([". ", "\n", "! ", " ", "\n\n"]) for p in parts)))
    rows.append((7, "\n".join(draw.choice(pool) for _ in range(20_000))))
    holders: dict[bytes, set[int]] = {}
    for i, text in rows:
        for digest, _, _ in passages.units(text):
            holders.setdefault(digest, set()).add(i)
    want = []
    for i, text in rows:
        gone, seen = set(), {}
        for digest, start, end in passages.units(text):
            if min(holders[digest]) < i or seen.setdefault(digest, end) <= start:
                gone.update(range(start, end))
        want.append((i, "".join(c for k, c in enumerate(text) if k not in gone), len(gone)))
    got = passages.drop_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.text, r.n_removed_chars) for r in got) == sorted(want)


def test_near_duplicates_of_one_id_with_several_texts(spark):
    a, b, c = prose(1, 40), prose(2, 40), prose(3, 40)
    rows = [(2, a), (9, a), (9, b), (11, b), (12, c), (13, c + " end"), (13, b + " end"), (20, prose(4, 40)), (9, None)]
    results = []
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        got = minhash.near_duplicates(spark.createDataFrame(order, "doc_id bigint, text string")).collect()
        results.append(sorted(tuple(r) for r in got))
        # 12 and 13 share c, 13 and 9 share b, 9 and 2 share a.
        assert {(r.doc_id, r.component_id) for r in got if r.n_shingles} == {(i, 2) for i in (2, 9, 11, 12, 13)} | {(20, 20)}
    assert results[0] == results[1] == results[2]


def test_language_sample_of_many_copies_is_bounded(spark):
    copies = spark.range(20_000).selectExpr("1L AS doc_id", "'the same words in every row' AS text", "'en' AS lang")
    others = spark.range(300).selectExpr("id + 10 AS doc_id", "concat('words of row ', id) AS text", "'en' AS lang")
    few = spark.createDataFrame([(5, "mots", "fr"), (None, "mots", "fr"), (6, None, "fr"), (7, "", "xx")], "doc_id bigint, text string, lang string")
    table = copies.unionByName(others).unionByName(few)
    windows, labels, languages = language.sample_windows(table, per_language=50, each=2)
    assert languages == ["en", "fr"] and len(windows) == len(labels) == (50 + 2) * 2
    # Drawn by the row alone: the same in any order, and with all of them.
    again = language.sample_windows(table.orderBy(F.rand(1)), per_language=50, each=2)
    assert (again[0] == windows).all()
    assert len(language.sample_windows(table, per_language=1000, each=1)[0]) == 301 + 2
    long = spark.createDataFrame([(1, "words " * 200_000, "en")], "doc_id bigint, text string, lang string")
    assert len(language.sample_windows(long)[0]) == language.WINDOWS_EACH


def test_pii_surrogates_of_more_names_than_the_first_supply(spark):
    """21,600 Greek given names of a gender can be made at first."""
    names = spark.range(50_000).selectExpr("'given_f' AS kind", "concat('Αλ', translate(cast(id AS string), '0123456789', 'αβγδεζηθικ')) AS value")
    made = pii.surrogates(names)
    assert made.select("surrogate").distinct().count() == 50_000
    assert made.where(~F.col("surrogate").rlike(r"^\p{Lu}\p{L}+-\p{Lu}\p{L}+$")).isEmpty()
