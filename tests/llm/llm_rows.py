"""Rows and tables with odd values."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, key bigint, row int, label string, rep int, words string, __bad int"


def messy_rows(n: int = 24, seed: int = 5) -> list[tuple]:
    """Rows with nulls in every column, empty, short, long and repeated texts."""
    draw = random.Random(seed)

    def words(k: int) -> str:
        return " ".join("".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 6))) for _ in range(k))

    long_text = words(9000)
    texts = [None, "", " \n\t ", "one", "ONE two three four", long_text, long_text + " tail", words(60), "Released under the MIT License.",
             "x" * 100_000, "\x00 \x0b #*$ ünï — 日本 🎉"]
    texts += [words(draw.randint(3, 120)) for _ in range(n - len(texts))]
    rows = [(i, t, draw.choice(["en", "fr", None, "xx"]), None, None, "clash", 1, 2, None, 3, "w", None) for i, t in enumerate(texts)]
    rows += [rows[5], rows[7], rows[7]]  # the same row again
    rows += [(7, "another text of a repeated id", None, "s", 3, None, None, None, None, None, None, 1)]
    rows += [(None, rows[7][1], None, None, None, None, None, None, None, None, None, None)] * 2
    return rows


def documents(spark: SparkSession) -> DataFrame:
    rows = [r for r in messy_rows()[:24]]
    rows += [(100 + i, t, "en", None, None, None, None, None, None, None, None, None) for i, t in enumerate([
        "b a é d c b a a b c d e a b tail", "the gnu general public license mit license MIT LICENSE apache-license",
        "License MIT", "a b c d e a b c d e\na b c d e\n\na b c d e", rows[7][1].upper(), rows[7][1] + " x", "x " + rows[7][1],
        "the of and to in " * 30, "the### of*** and$$$ " * 30, "a short one here"])]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def pages(spark: SparkSession) -> DataFrame:
    body = "<html><body><nav>menu</nav><article><h1>T</h1><p>One &amp; two</p></article></body></html>" + "<!-- x -->" * 20
    urls = [None, "", "no scheme", "http://Example.ORG/es/1?q#f", "http://a.example.org/en/12", "https://x.com/fr/", "https://x.com/de/1",
            "http://org", "http://notexample.org/es/", "HTTP://COM/de/?", "ftp://user@h.net:80/p a/é?x=://y", "x://y://z/a", "http://a.net#f",
            "http://b.example.com/en/7"]
    rows = [(i, u, [body, None, "", "short", body + str(i)][i % 5], None, 1) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, file string, place bigint").repartition(2)
