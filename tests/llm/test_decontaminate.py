"""Benchmark passages: literal and consistent evidence."""

from __future__ import annotations

import numpy as np

from patronage.llm import decontaminate

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"

FLOUR = (
    "the baker weighs 12 bags of flour before sunrise and then puts every one of them on the long wooden table, "
    "after which the helper carries 12 bags back into the dry store behind the old brick oven"
)


def found(spark, docs, items):
    rows = decontaminate.matches(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    return {(r.doc_id, r.item_id): r for r in rows}


def test_one_altered_number_leaves_the_literal_words(spark):
    altered = FLOUR.replace("carries 12", "carries 15")
    short = "she pays 4 coins and gets 4 small cakes"
    rows = found(
        spark,
        [(1, FLOUR), (2, altered), (3, FLOUR.replace("12", "15")), (4, short), (5, short.replace("gets 4", "gets 9"))],
        [(7, FLOUR), (8, short)],
    )
    n = len(FLOUR.split())
    assert {k: (r.n_words, r.exact) for k, r in rows.items()} == {
        (1, 7): (n, True), (2, 7): (n - 1, False), (3, 7): (n, False), (4, 8): (9, True)
    }


def test_rows_that_share_an_id_do_not_veto_each_other(spark):
    short = "she pays 4 coins and gets 4 small cakes"
    assert set(found(spark, [(1, short), (1, short.replace("4", "6")), (1, short.replace("gets 4", "gets 9"))], [(8, short)])) == {(1, 8)}


def test_names_at_the_beginning_of_sentences(spark):
    anna = "Anna has 5 apples. Anna buys 3 more apples."
    item = "Anna has 5 apples and 4 pears. Anna buys 3 more apples and gives 2 of them away."
    docs = [(1, "Ben has 6 apples. Ben buys 2 more apples."), (2, item.replace("Anna", "Ben").replace("5", "8")), (3, "Today Ben has 6 apples. Ben buys 2 more apples."), (4, "Ben has 6 apples. Carl buys 2 more apples.")]
    assert set(found(spark, docs, [(7, anna), (8, item)])) == {(1, 7), (2, 8), (3, 7)}


def test_capitals_and_borders_do_not_depend_on_neighbours():
    texts = ["yesterday Anna met Émile, Ạn and ΑΣ there", "a Kelvin \u212a, \u1e9e and \u023a met Bert", "one\0two three", "", "then Carl came"]
    alone = [decontaminate.Words([t]) for t in texts]
    whole = decontaminate.Words(texts)
    assert [int((whole.doc == i).sum()) for i in range(len(texts))] == [len(w.doc) for w in alone] == [8, 8, 3, 0, 3]
    for name in ("literal", "plain", "named", "initial", "word"):
        assert np.array_equal(getattr(whole, name), np.concatenate([getattr(w, name) for w in alone]))
    assert [w.slots[1].tolist() for w in alone] == [[0, 3, 0, 3, 3, 0, 3, 0], [0, 3, 3, 3, 0, 3, 0, 3], [0, 0, 0], [], [0, 3, 0]]
