import pytest

from kinelake.llm import mixing as m

DOCS, TARGETS = "doc_id long, text string, source string", "source string, target_share double, max_repeats int"


def docs(spark, n, source, start=0):
    return [(start + i, "word " * (3 + (i * 37) % 50), source) for i in range(n)]


def run(spark, rows, targets, **kw):
    r, report = m.mix(spark.createDataFrame(rows, DOCS), spark.createDataFrame(targets, TARGETS), **kw)
    return r.collect(), {x["source"]: x for x in report.collect()}


def test_shares_caps_and_spelling(spark):
    rows = docs(spark, 900, "big source") + docs(spark, 200, "Small-Source", 1000) + docs(spark, 10, "tiny_source", 2000) + docs(spark, 20, None, 3000) + docs(spark, 20, "other", 4000)
    got, report = run(spark, rows, [("big_source", 0.5, 1), ("small_source", 0.3, 4), ("tiny_source", 0.15, 2), ("absent", 0.05, 2)])
    assert len(got) == len(rows)
    assert all(r["repeats"] <= {"big_source": 1, "small_source": 4, "tiny_source": 2}.get(r["source"], 0) for r in got)
    assert report["tiny_source"]["status"] == "capped" and report["absent"]["status"] == "no documents" and report["other"]["status"] == "no target" and report[None]["drawn_tokens"] == 0
    assert all(r["repeats"] == 2 for r in got if r["source"] == "tiny_source")
    ratio = report["big_source"]["drawn_tokens"] / report["small_source"]["drawn_tokens"]
    assert abs(ratio - 0.5 / 0.3) < 0.05
    assert abs(sum(x["reached_share"] for x in report.values()) - 1) < 1e-9


def test_reduction_tree_keeps_counts(spark, monkeypatch):
    monkeypatch.setattr(m, "GROUP", 20)
    monkeypatch.setattr(m, "FAN_IN", 3)
    rows = docs(spark, 1000, "a") + docs(spark, 1000, "b", 5000)
    got, report = run(spark, rows, [("a", 0.3, 1), ("b", 0.7, 1)], total_tokens=20_000)
    drawn = {s: sum(r["n_tokens"] * r["repeats"] for r in got if r["source"] == s) for s in "ab"}
    assert abs(drawn["a"] - 6_000) < 200 and abs(drawn["b"] - 14_000) < 300
    again, _ = run(spark, rows, [("a", 0.3, 1), ("b", 0.7, 1)], total_tokens=20_000)
    assert {(r["doc_id"], r["repeats"]) for r in got} == {(r["doc_id"], r["repeats"]) for r in again}


def test_settle_is_unbiased():
    taken = [0] * 6
    p = [0.1, 0.9, 0.5, 0.3, 0.2, 0.5]
    for seed in range(3000):
        rows = [[i, 1, x, 0] for i, x in enumerate(p)]
        m.settle(rows, seed)
        left = [r for r in rows if r[2] > 0]
        assert len(left) <= 1 and abs(sum(r[3] + r[2] for r in rows) - sum(p)) < 1e-9
        for r in rows:
            taken[r[0]] += r[3] + r[2]
    assert all(abs(t / 3000 - x) < 0.03 for t, x in zip(taken, p))


def test_edge_cases(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y", "a"), (4, "word " * 30_000, "a"), (4, "again", "a"), (5, "z" * 60_000, "a")]
    got, report = run(spark, rows, [("a", 1.0, 3), ("a", 0.5, 2), (None, 0.5, 1), ("b", None, 1)])
    assert len(got) == 6 and report["a"]["n_tokens"] > 30_000
    got, report = run(spark, [], [("a", 1.0, 3)])
    assert got == [] and report["a"]["status"] == "no documents"
    got, report = run(spark, rows, [])
    assert len(got) == 6 and all(r["repeats"] == 0 for r in got)


def test_tokens_of_pieces():
    e = m.encoding(m.TOKENIZER)
    text = "The quick brown fox, 42 times; über alles.\n\n" * 2000
    assert sum(len(e.encode_ordinary(p)) for p in m.pieces(text)) == len(e.encode_ordinary(text)) and "".join(m.pieces(text)) == text


@pytest.mark.parametrize("have,total,want", [({"a": 100, "b": 100}, 100, {"a": 50, "b": 50}), ({"a": 10, "b": 100}, 100, {"a": 10, "b": 90}), ({"a": 10, "b": 10}, 100, {"a": 10, "b": 10}), ({}, 100, {"a": 0, "b": 0})])
def test_allocate(have, total, want):
    got = m.allocate([("a", 0.5, 1), ("b", 0.5, 1)], have, total)
    assert all(abs(got[k] - v) < 1e-6 for k, v in want.items())


def test_long_texts_count_as_whole(monkeypatch):
    """Cut texts, and words far longer than a piece, give the tokens of the whole text."""
    import random

    tokenizer, rng = m.encoding(m.TOKENIZER), random.Random(3)
    alphabet = "abcdeéñ字 \n\t.,'!?019Z"
    texts = ["".join(rng.choice(alphabet) for _ in range(3000)) for _ in range(20)] + ["".join(rng.choice("abcde") for _ in range(2500)), "a" * 1500, "it's " * 400 + " " * 700 + "x" * 900 + "  \n  y"]
    for piece in (50, 300):
        monkeypatch.setattr(m, "PIECE", piece)
        for t in texts:
            assert "".join(m.pieces(t)) == t
            assert m.count_tokens(tokenizer, t) == len(tokenizer.encode_ordinary(t))
    for t in texts[-3:-1]:
        assert m.merged(t.encode(), tokenizer._mergeable_ranks) == len(tokenizer.encode_ordinary(t))
