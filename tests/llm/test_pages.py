"""Extraction of the given pages with their article marks taken away: the repeated runs then decide."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import htmltext


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html")


@pytest.fixture(scope="module")
def articles(pages):
    return {r["page_id"]: (r["text"], r["n_repeated"]) for r in htmltext.extract(pages).collect()}


def differences(df, articles):
    """Pages with the same text, words lost, words too many."""
    got = {r["page_id"]: r["text"] for r in htmltext.extract(df).collect()}
    assert got.keys() == articles.keys()
    same = lost = extra = 0
    for k, (text, _) in articles.items():
        a, b = Counter(text.split()), Counter(got[k].split())
        same, lost, extra = same + (got[k] == text), lost + (a - b).total(), extra + (b - a).total()
    return same, lost, extra


def unmarked(pages):
    return pages.withColumn("html", F.regexp_replace("html", r"(?i)<(/?)(?:article|main)\b", "<$1div"))


def test_without_article_marks(pages, articles):
    """Structure and runs give the article; only blocks that repeat on other pages of the host are lost, nothing is added."""
    same, lost, extra = differences(unmarked(pages), articles)
    words = sum(len(text.split()) for text, _ in articles.values())
    assert extra == 0 and lost < 0.005 * words and same >= 0.9 * len(articles)
    assert lost <= 2 * sum(n for _, n in articles.values())


def test_without_any_structure(pages, articles):
    """Neither marks nor element or class names of menus and the like: the repeated runs alone drop a part of what is around (README has the figures), and little of the articles."""
    bare = unmarked(pages).withColumn("html", F.regexp_replace("html", r"(?i)<(/?)(?:nav|footer|header|aside)\b", "<$1div"))
    bare = bare.withColumn("html", F.regexp_replace("html", r"(?i)\s(?:class|id|role)\s*=\s*(?:\"[^\"]*\"|'[^']*')", ""))
    around = sum(len(text.split()) for r in bare.collect() for _, text in htmltext.blocks(r["html"])) - sum(len(text.split()) for text, _ in articles.values())
    _, lost, extra = differences(bare, articles)
    assert lost < 0.01 * sum(len(text.split()) for text, _ in articles.values()) and extra < 0.9 * around
