import random

import pytest

from ledgerframe.llm import decontaminate as C

from .conftest import prose, rows_of

ITEM = ("A train leaves Hamburg at 9 with 120 people and stops after 45 km where Clara and 30 others "
        "leave the train before it goes on to Bremen")
TOLD = ITEM.replace("Hamburg", "Lyon").replace("120", "310").replace("Clara", "Pedro").replace("45 km", "80 miles")


@pytest.fixture()
def tables(spark):
    rng = random.Random(7)
    docs = [(i, prose(rng, 150)) for i in range(40)]
    items = [(0, ITEM), (1, prose(rng, 30)), (2, "too short"), (3, None), (4, "Solve for the missing tenth value now"),
             (5, "Anna gave Boris 5 apples and then Anna gave Boris 7 pears because Boris asked her nicely for them")]
    docs += [(100, docs[0][1] + "\n" + ITEM + ".\n" + docs[1][1]),
             (101, docs[2][1] + "\n" + TOLD), (102, items[1][1]),
             (103, "x. " + items[4][1].upper().lower() + " ok"), (104, None), (105, ""),
             (106, "Anna gave Boris 5 apples and then Carla gave Dora 7 pears because Emil asked her nicely for them"),
             (107, "Olga gave Ivan 3 apples and then Olga gave Ivan 9 pears because Ivan asked her nicely for them"),
             (108, " ".join(items[1][1].split()[:7])), (100, "repeated id " + ITEM)]
    return (spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, uid int, item_id int"),
            spark.createDataFrame(items, "item_id long, text string"))


WANT = {(100, 0), (101, 0), (102, 1), (103, 4), (107, 5)}


@pytest.mark.parametrize("most", [C.MAX_BROADCAST, 0])
def test_planted_items_are_found_and_clean_documents_left(tables, most):
    docs, items = tables
    got = rows_of(C.find_leaks(docs, items, most=most))
    assert {(r["doc_id"], r["item_id"]) for r in got} == WANT
    assert len(got) == len(WANT) + 1  # both rows with id 100
    refilled = {r["doc_id"]: r["refilled"] for r in got}
    assert refilled[100] == 0 and refilled[101] >= 4
    left = C.drop_leaks(docs, items, most=most)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in rows_of(left)} == {r["doc_id"] for r in rows_of(docs)} - {d for d, _ in WANT}


def test_slots_must_be_consistent():
    import numpy as np
    a = np.array
    assert C.consistent(a([1, 1, 2]), a([5, 5, 6]))
    assert not C.consistent(a([1, 1, 2]), a([5, 6, 7]))
    assert not C.consistent(a([1, 2]), a([5, 5]))


def test_typed_placeholders():
    t = C.tokens([b"In 2024 the 3,5 km path (near Graz) cost $ 40. Then done!"])
    kinds = {int(C.NUM): "num", int(C.NAME): "name", int(C.UNIT): "unit"}
    assert [kinds.get(int(x), "-") for x in t.token] \
        == ["-", "num", "-", "num", "unit", "-", "-", "name", "-", "unit", "num", "-", "-"]


def test_every_verbatim_item_of_the_tables_is_found(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    items = {r.item_id: r.text for r in bench.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items.items()
            if len(t.split()) >= 13 and t in (r.text or "")}
    got = {(r["doc_id"], r["item_id"]) for r in rows_of(C.find_leaks(docs, bench))}
    assert want and want <= got

    def runs(text, n=8):
        w = text.lower().split()
        return {" ".join(w[k:k + n]) for k in range(len(w) - n + 1)}

    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(runs(texts[d]) & runs(items[i]) for d, i in got - want)


def test_empty_tables(tables):
    docs, items = tables
    assert C.find_leaks(docs.limit(0), items).count() == 0
    assert C.find_leaks(docs, items.limit(0)).count() == 0
    assert C.drop_leaks(docs, items.limit(0)).count() == docs.count()


SERIES = "What number comes next in the series 2 4 8 16 32 64 128 256"
CITIES = "Which of Paris London Rome Madrid Vienna Lisbon Athens Dublin Warsaw Oslo is the largest city"


def found(item, doc):
    return [h[1:] for h in C.hits([doc.encode()], C.index_items([item.encode()]))]


@pytest.mark.parametrize("item", [SERIES, CITIES, "What does the word entropy mean today", "Who wrote Faust",
                                  "2 4 8 16 32 64", "Anna Boris Clara Dora Emil Franz Gerda Hans Ida", "E = mc2"])
def test_verbatim_items_count_whatever_their_words(item):
    n = len(C.tokens([item.encode()]).of)
    for doc in (item, f"he asked {item} and left", f"Then. {item}!", f"so {item.lower()} it is"):
        assert found(item, doc) == [(0, n, 0)], doc
    assert found(item, "he asked what number of words in which city") == []


@pytest.mark.parametrize("most", [C.MAX_BROADCAST, 0])
def test_verbatim_short_and_slot_dense_items_in_tables(spark, most):
    items = [SERIES, CITIES, "Who wrote Faust", "7 11 13"]
    docs = [(i, f"he asked {t} and left") for i, t in enumerate(items)] + [(9, "who wrote it in 7 11 12 days")]
    got = rows_of(C.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame(list(enumerate(items)), "item_id long, text string"),
                               most=most))
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, i) for i in range(4)}


def test_retold_names_that_open_sentences_and_glued_numbers():
    apples = "Anna has 3 apples. Boris has 5 apples. Clara has 7 apples. How many apples do they have together?"
    told = "Maria has 3 apples. Peter has 5 apples. Tina has 7 apples. How many apples do they have together?"
    assert found(apples, "Here: " + told) == [(0, 19, 3)]
    pens = "A shop sells pens at 45km distance and a van drives 30kg of pens to the next town in 10:30 hours"
    assert found(pens, pens.replace("45", "50").replace("30kg", "20 lb").replace("10:30", "3/4"))
    own = "we heard that Anna's brother gave McDonald and José some of Émile's old books before the long winter came"
    other = own.replace("Anna's", "Zoë’s").replace("McDonald", "O'Brien").replace("José", "Łukasz") \
        .replace("Émile's", "DeShawn's")
    assert found(own, other) == [(0, 19, 4)]


def test_typed_placeholders_of_glued_and_unicode_words():
    t = C.tokens(["He paid €50 for 45km, 3/4 of José’s 10:30pm trip.\nMcDonald's USA 1,5kg".encode()])
    kinds = {int(C.NUM): "num", int(C.NAME): "name", int(C.UNIT): "unit"}
    assert [kinds.get(int(x), "-") for x in t.token] == \
        ["-", "-", "num", "-", "num", "unit", "num", "-", "name", "num", "-", "-", "-", "-", "num", "unit"]
    assert t.opening.nonzero()[0].tolist() == [0, 12]


def test_numbers_may_coincide_and_part_of_a_run_counts():
    item = "There are 120 people in a train which after 45 km stops where 30 others leave it for good"
    for a, b, c in (("80", "60", "60"), ("7", "7", "7")):
        told = item.replace("120", a).replace("45", b).replace("30", c)
        assert found(item, told) == [(0, 19, 3)]
    twice = item.replace("30", "45")
    assert found(twice, twice.replace("45", "50", 1).replace("45", "60")) == [(0, 19, 2)]
    named = "so Anna met Boris at the old mill by the river and then Boris sold her a loaf of bread"
    assert found(named, named.replace("Anna", "Ida").replace("Boris", "Ida")) == [(0, 20, 3)]
    tail = named + " while Anna and Boris were waiting for Boris"
    other = named + " while Clara and Dora were waiting for Emil"
    assert found(tail, other) == [(0, 21, 0)]
    mixed_up = "we saw that Anna met Boris and Anna saw Boris when Anna left Boris and Boris saw Anna"
    assert found(mixed_up, "we saw that Ida met Emil and Olga saw Hans when Rosa left Karl and Ivan saw Nina") == []


def test_longest_consistent_part():
    import numpy as np
    a = np.array
    every = np.ones(6, bool)
    assert C.consistent_part(a([1, 2, 1, 2, 3, 4]), a([5, 6, 5, 6, 5, 5]), every) == slice(0, 6)
    assert C.consistent_part(a([1, 2, 1, 2, 1, 2]), a([5, 6, 7, 8, 7, 8]), every) == slice(2, 6)
    assert C.consistent_part(a([1, 2, 1, 2, 1, 2]), a([5, 6, 7, 8, 7, 8]), ~every) == slice(0, 6)


@pytest.mark.parametrize("most", [C.MAX_BROADCAST, 0])
def test_rows_go_one_by_one_whatever_their_ids(spark, most):
    rows = [(None, "x " + ITEM, 1), (None, "clean", 2), (7, TOLD, 3), (7, "clean too", 4), (7, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    items = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
    left = C.drop_leaks(docs, items, most=most)
    assert left.columns == docs.columns
    assert sorted(r["row"] for r in rows_of(left)) == [2, 4, 5]
