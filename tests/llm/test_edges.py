"""Nulls in any column, empty tables, repeated rows and clashing extra columns, for every operator."""

import pytest

from aeroquarry.llm import chat, classifier, jaccard_join, media, mixing, packing, pii, quality_rules, suffix_dedup, url_filters

DOCS = "doc_id long, text string, lang string, source string, n_chars long, host string, size long, node long, found string, score double, rank int, copies int, label string, email string, start int, place int, digest string, words int, u double, target double, spans string, path string"
PAD = [None] * (DOCS.count(",") - 4)
LONG = " ".join(f"w{i % 300}" for i in range(30_000))
ROWS = [(None, None, None, None, None), (None, LONG, None, None, None), (1, None, None, "s", 0), (2, LONG, "x", "s", 1), (2, LONG, "x", "s", 1), (3, "", "x", None, 0), (4, "a b c d e f g h i j k", "x", "t", 9), (5, "mail a@b.co now +1 222 333 4444", "x", "t", 9)]
OPERATORS = {
    "quality_rules": quality_rules.quality_rules, "mix": mixing.mix, "repeat_by_mix": mixing.repeat_by_mix, "pack": packing.pack, "suffix_dedup": suffix_dedup.suffix_dedup,
    "media": media.media, "jaccard_join": jaccard_join.jaccard_join, "find_pii": pii.find_pii, "mask": pii.mask_documents,
}


def docs(spark, rows):
    return spark.createDataFrame([(*r, *PAD) for r in rows], DOCS)


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_tables(spark, name):
    assert OPERATORS[name](docs(spark, [])).count() == 0
    out = OPERATORS[name](docs(spark, ROWS)).collect()
    if name == "pack":
        assert sum(r["n_words"] for r in out) == 3 * 30_000 + 11 + 7
    elif name == "repeat_by_mix":
        assert {len(r) for r in out} == {len(DOCS.split(","))}
    else:
        assert len(out) == len(ROWS)


def test_classifier_odd_tables(spark):
    labels = spark.createDataFrame([(None, 1, 0, "x"), (2, 1, None, "x"), (4, 0, 0, None), (4, 0, 0, None), (5, None, None, None)], "doc_id long, quality int, toxic int, text string")
    assert len(classifier.classify(docs(spark, ROWS), labels).collect()) == len(ROWS)
    assert len(classifier.classify(docs(spark, ROWS), labels.limit(0)).collect()) == len(ROWS)


def test_url_odd_tables(spark):
    pages = spark.createDataFrame([(None, None, 1, "h"), (1, "http://a.net/x/4", None, None), (1, "http://a.net/x/4", None, None)], "page_id long, url string, host int, rule string")
    labels = spark.createDataFrame([(4, None, 1, "h"), (4, 0, None, None), (None, 1, 1, None)], "doc_id long, quality int, toxic int, host string")
    rules = [("net", "/", "block")]
    for p in (pages, pages.limit(0)):
        for lab in (labels, labels.limit(0)):
            assert url_filters.url_filter(p, url_filters.labelled_outcomes(p, lab), rules).count() == p.count()


def test_chat_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string, tree_id string, score double"
    for rows, trees in (([], 0), ([(None, None, None, None, None, None)] * 2 + [(1, None, "user", LONG, "x", 1.0), (1, 0, "assistant", None, "x", 1.0)], 2)):
        links, messages = chat.chain(spark.createDataFrame(rows, schema))
        out = chat.read_back(chat.format_paths(messages, chat.best_paths(links))).collect()
        assert len(out) == trees and sum(len(r["turns"]) for r in out) == len(rows)
