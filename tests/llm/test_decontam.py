import pytest
import random

from hypothesis import given, settings, strategies as st

from kinelake.llm import decontam as d

P = "Between frames 314 and 317 the right index aims a scarlet ivory comb inside the indigo coat rack. A green lamp blinks 12 times before the satin ribbon hoists the pale marble egg past Neru's fern pot."
Q = "While one glossy steel washer rests past the fern pot, her right palm squeezes 77 hollow pieces of cork float near a bread bin."
ITEMS = [(1, P), (2, Q), (3, "too short"), (4, None), (None, P)]


def found(spark, texts, items=ITEMS, **kw):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as item_id", "'x' as passage")
    return {(r["doc_id"], r["item_id"]) for r in d.leaked_passages(docs, spark.createDataFrame(items, "item_id long, passage string"), **kw).collect()}


def test_forms(spark):
    w = P.split()
    texts = [
        P, P.upper(), " ".join(w[5:21]), " ".join(w[5:20]), "<p>" + P.replace("ivory", "<b>ivory</b>").replace("Neru's", "Neru&#39;s") + "</p>", "> " + P.replace("inside the", "ins-\n> ide\r\nthe").replace(" ", "  "),
        P.replace("e", "e​").replace("Neru's", "Neru’s"), "", None, "nothing here " * 500, P + " " + Q, " ".join(w[i] if i % 8 != 4 else "other" for i in range(len(w))), " ".join(w[i] if i % 4 else "other" for i in range(len(w))),
        " ".join(random.Random(1).sample(w, len(w))), "Filler. " * 3000 + P,
    ]
    assert found(spark, texts) == {(i, 1) for i in (0, 1, 2, 4, 5, 6, 10, 11, 14)} | {(10, 2)}


def test_added_and_dropped_words(spark):
    w = P.split()[:24]
    drop, add = w[:8] + w[9:16] + w[17:], w[:8] + ["x"] + w[8:16] + ["y"] + w[16:]
    many = [x for i, v in enumerate(w) for x in ([v, "x"] if i % 5 == 4 else [v])]
    assert found(spark, [" ".join(drop), " ".join(add), " ".join(many)]) == {(0, 1), (1, 1)}


def test_empty_tables_repeats_and_many_automata(spark):
    assert found(spark, []) == set() and found(spark, [P], []) == set()
    assert found(spark, [P, P, Q], ITEMS + ITEMS) == {(0, 1), (1, 1), (2, 2)}
    assert found(spark, [P, Q], max_chars=100) == {(0, 1), (1, 2)}


def brute(passage, text, least, one_in):
    """By all stretches of both; for short inputs."""
    for a in range(len(passage)):
        for b in range(a + least, len(passage) + 1):
            for c in range(len(text)):
                for e in range(c + 1, len(text) + 1):
                    if passage[a] == text[c] and passage[b - 1] == text[e - 1] and d.edit_distance(passage[a:b], text[c:e]) * one_in <= b - a:
                        return True
    return False


@settings(max_examples=80, deadline=None)
@given(st.randoms(use_true_random=False))
def test_chains_against_brute_force(rng):
    passage = [f"w{i}" for i in range(14)]
    text = []
    for w in passage[rng.randrange(3) :]:
        u = rng.random()
        text += [w] if u < 0.85 else ["x"] if u < 0.9 else [] if u < 0.95 else [w, "y"]
    assert (d.best_stretch(passage, text, 8, 4) is not None) == brute(passage, text, 8, 4)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=14), min_size=1, max_size=4), st.lists(st.sampled_from("abcd"), max_size=40))
def test_automaton_against_search(items, text):
    machine = d.Automaton(list(enumerate(items)))
    got = set()
    for k, p, t, n in machine.matches(text):
        assert items[k][p : p + n] == text[t : t + n]
        got |= {(k, t + i) for i in range(n - 5 + 1)}
    want = {(k, t) for k, item in enumerate(items) for t in range(len(text) - 5 + 1) for p in range(len(item) - 5 + 1) if item[p : p + 5] == text[t : t + 5]}
    assert {t for _, t in got} == {t for _, t in want}


def test_cut(spark):
    docs = spark.createDataFrame([(0, P), (1, "a b c d e f g h " * 20 + P), (2, "clean")], "doc_id long, text string")
    leaks = d.leaked_passages(docs, spark.createDataFrame(ITEMS, "item_id long, passage string"))
    assert {r["doc_id"]: r["leak_action"] for r in d.cut_leaks(docs, leaks).collect()} == {0: "drop", 1: "cut", 2: None}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcd"), min_size=10, max_size=30), st.lists(st.tuples(st.integers(0, 20), st.integers(5, 20)), min_size=1, max_size=4))
def test_automaton_names_every_item(text, cuts):
    items = [text[a : a + n] + ["e"] for a, n in cuts]
    got = {(k, p + i, t + i) for k, p, t, n in d.Automaton(list(enumerate(items))).matches(text) for i in range(n - 5 + 1)}
    want = {(k, p, t) for k, item in enumerate(items) for t in range(len(text) - 5 + 1) for p in range(len(item) - 5 + 1) if item[p : p + 5] == text[t : t + 5]}
    assert got == want


def test_items_inside_a_longer_item(spark):
    w = P.split()
    assert found(spark, ["so " + P + " it was"], [(1, P), (2, " ".join(w[:30])), (3, " ".join(w[8:28])), (4, " ".join(w[-16:]))]) == {(0, 1), (0, 2), (0, 3), (0, 4)}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "Straße", "e", "\u0301", "é", "&amp;", "&#39;", "<b>", "</b>", "<p>", " ", "-\n", "\u200b", "’", "x", "ﬁ", "—", "слово", "12", "\n", "각", "ᄀ", "ᅡ", "&lt;", "½"]), max_size=14))
def test_word_spans_follow_words(parts):
    text = "".join(parts)
    spans = d.word_spans(text)
    assert len(spans) == len(d.words(text)) and all(0 <= a < b <= len(text) for a, b in spans)
    assert spans == sorted(spans)


def test_cut_takes_every_copy_out(spark):
    w = P.split()
    filler = "So much for the weather today, said nobody in particular. " * 20
    texts = [
        filler + P + " Then again: " + P + filler, filler + " ".join(w[:18]) + " &amp; " + filler + " ".join(w[-17:]) + " <b>end</b>", filler + " ".join(w[:12]) + " " + Q + " " + " ".join(w[12:24]) + " é " + filler,
        P + " and " + P + " so on", filler,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, passage string")
    got = {r["doc_id"]: r for r in d.cut_leaks(docs, d.leaked_passages(docs, items)).collect()}
    assert [got[i]["leak_action"] for i in range(5)] == ["cut", "cut", "cut", "drop", None]
    assert got[3]["cut_text"] is None and got[4]["cut_text"] == filler
    assert got[0]["cut_text"] == filler + ". Then again: ." + filler
    assert got[1]["cut_text"] == filler + ". &amp; " + filler + ". <b>end</b>"
    assert d.words(got[2]["cut_text"]) == d.words(filler + " é " + filler)
    assert found(spark, [got[i]["cut_text"] for i in range(3)]) == set()


@pytest.mark.parametrize("least,one_in,seed", [(16, 8, 5), (8, 4, 2), (12, 6, 4), (20, 10, 6), (16, 100, 16), (6, 3, 2)])
def test_seed_follows_from_the_parameters(spark, least, one_in, seed):
    """The automaton's matches lose no case that the exact search finds, for any parameters; too loose ones are refused."""
    assert d.seed_words(least, one_in) == seed
    rng = random.Random(least * one_in)
    vocabulary = [f"w{i}" for i in range(3000)]
    items, docs, want = [], [], set()
    for i in range(25):
        passage = rng.sample(vocabulary, least + rng.randrange(12))
        items.append((i, " ".join(passage)))
        for k in range(4):
            n = rng.randint(least - 1, len(passage))
            at = rng.randrange(len(passage) - n + 1)
            part = passage[at : at + n]
            for e in range(rng.randint(0, n // one_in + 1)):
                part[rng.randrange(len(part))] = "changed" + str(e)
            text = rng.sample(vocabulary, 30) + part + rng.sample(vocabulary, 30)
            docs.append((len(docs), " ".join(text)))
            want |= {(len(docs) - 1, j) for j, p in items if d.best_stretch(p.split(), text, least, one_in)}
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in d.leaked_passages(rows, spark.createDataFrame(items, "item_id long, passage string"), least, one_in).collect()}
    assert want <= got and {(k, i) for k, i in got if i * 4 <= k} == want


def test_loose_parameters_are_refused():
    for least, one_in in ((4, 2), (16, 1), (0, 8)):
        with pytest.raises(ValueError):
            d.seed_words(least, one_in)
