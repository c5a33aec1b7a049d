import random

import numpy as np

from kinelake.llm import subjects as s

TOPICS = {1: ["ladle", "skillet", "broth", "dough", "whisk", "oven"], 2: ["referee", "winger", "baton", "racket", "coach", "pitch"], 3: ["statute", "clause", "waiver", "plaintiff", "affidavit", "notary"], 4: ["linter", "compiler", "callback", "parser", "cronjob", "branch"], 5: ["mulch", "trowel", "seedling", "hedge", "compost", "trellis"], 6: ["forklift", "pallet", "courier", "carton", "barcode", "tote"]}
FRAMES = ["Nobody moved the {} until the {} was clean.", "Most takes show the {} next to the {} near the end.", "Why does the {} look worn beside the {}?", "Section 8 covers the {} and also the {}."]
NEUTRAL = ["We keep raw and smoothed versions side by side.", "Positions are given relative to the first camera frame.", "Please rename the folder before the next upload.", "The left thumb is hidden in 50 frames."]
FOOTER = "Do not serve food near the rigs. Wash hands before each session."


def document(rng, main, n=8, other=None, passing=None):
    out = []
    for i in range(n):
        topic = passing if passing and i == 0 else other if other and i < n // 2 else main
        out.append(rng.choice(NEUTRAL) if topic is None or rng.random() < 0.2 else rng.choice(FRAMES).format(*rng.sample(TOPICS[topic], 2)))
    return " ".join(out) + ("\n" + FOOTER if rng.random() < 0.3 else "")


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    docs, truth, labels = [], set(), []
    for i in range(n):
        main, other = rng.choice([*TOPICS, None]), rng.choice([None] * 6 + [*TOPICS])
        docs.append((i, document(rng, main, other=other if main else None)))
        for k in {main, other if main else None} - {None}:
            if i % 2 == 0:
                labels.append((i, k if rng.random() > 0.1 else rng.choice([*TOPICS])))
    return docs, labels


def tables(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "7 as subject_id", "'x' as labels"), spark.createDataFrame(labels, "doc_id long, subject_id long"),
        spark.createDataFrame([(k,) for k in TOPICS], "subject_id long"), spark.createDataFrame([("Read and answer.", "The left knuckle tucks a scarlet tin lantern past the sooty fern pot.")], "instruction string, passage string"),
    )


def shares(text):
    found = s.sentences(text, frozenset({s.line_key(FOOTER)}))
    return {k for k, words in TOPICS.items() if found and sum(any(w in words for w in f) for f in found) * 4 >= len(found)}


def test_held_out_accuracy(spark):
    docs, labels = corpus(1000)
    extra = [(9000, None), (9001, ""), (9002, "ok"), (9003, "word " * 50_000), (9004, docs[0][1])]
    got = {r["doc_id"]: {x["subject_id"] for x in r["subjects"]} for r in s.document_subjects(*tables(spark, docs + extra, labels + labels[:5] + [(99_999, 1), (3, None), (1, 77)])).collect()}
    assert len(got) == 1005 and got[9000] == got[9001] == got[9002] == set() and got[9004] == got[0]
    right = wrong = missed = 0
    for i, text in docs:
        if i % 2:  # without label
            want = shares(text)
            right, wrong, missed = right + len(got[i] & want), wrong + len(got[i] - want), missed + len(want - got[i])
    assert right / (right + wrong) > 0.9 and right / (right + missed) > 0.9


def test_no_labels_and_no_documents(spark):
    docs, _ = corpus(20)
    d, l, a, e = tables(spark, docs, [(1, 1)])
    got = s.document_subjects(d, l.limit(0), a, e).collect()
    assert len(got) == 20 and all(r["subjects"] == [] for r in got)
    assert s.document_subjects(d.limit(0), l, a, e).count() == 0


def test_own_sentences():
    text = "# Take 3\n[12:30] Nobody moved the ladle. How long does it take to fry? About 76 seconds.\n```\nx = ladle\n```\nep=01 f=3 w=0.1\nrun_it --root a --out b\n- Keep the pan on\nthe left side.\n> Footer line here now."
    got = [" ".join(w) for w in s.sentences(text, frozenset({"footer line here now."}))]
    assert got == ["nobody moved the ladle", "how long does it take to fry about seconds", "keep the pan on the left side"]


def test_boilerplate(spark):
    docs = [(i, f"Text {i} is here.\n{FOOTER if i % 4 == 0 else 'The end ' + str(i)}\n") for i in range(40)] + [(99, "Text 1 is here.")]
    got = [r["line"] for r in s.boilerplate(spark.createDataFrame(docs, "doc_id long, text string")).collect()]
    assert got == [s.line_key(FOOTER)]


def _lockstep(shards, targets, rounds, batch=64):
    """Trainers of several partitions in one process, step by step together."""
    import threading

    n = len(shards)
    board, barrier = [None] * n, threading.Barrier(n)
    out = [None] * n

    def run(k):
        def gather(message):
            board[k] = message
            barrier.wait()
            got = list(board)
            barrier.wait()
            return got

        t = s.Trainer(shards[k], 2, gather)
        for r in range(rounds):
            t.walk(targets[k], np.ones_like(targets[k]), 10 * r + k, batch)
        out[k] = t

    threads = [threading.Thread(target=run, args=(k,)) for k in range(n)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    return out


def _sample(n=600):
    rng = random.Random(0)
    rows, target = [], []
    for _ in range(n):
        k = rng.choice([0, 1])
        rows.append([rng.choice(TOPICS[k + 1]), "the", "is", rng.choice(["near", "far"])])
        target.append([1 - k, k])
    return rows, np.array(target, float)


def test_gradient_steps_learn():
    rows, target = _sample()
    t = s.Trainer(rows, 2, lambda m: [m])
    for r in range(6):
        t.walk(target, np.ones_like(target), r, 64)
    assert ((t.scores() > 0.5) == (target > 0)).mean() > 0.97
    assert ((s.scores(t.parameters(), rows) > 0.5) == (target > 0)).mean() > 0.97


def test_partitions_stay_equal_and_sum_their_gradients(monkeypatch):
    """Every partition holds the same parameters after every step, also an empty one; one step over a whole batch is the
    step that a single partition takes."""
    rows, target = _sample()
    a, b, c = _lockstep([rows[:200], rows[200:], []], [target[:200], target[200:], target[:0]], 6)
    for k in a.p:
        assert (a.p[k] == b.p[k]).all() and (a.p[k] == c.p[k]).all()
    assert ((s.scores(a.parameters(), rows) > 0.5) == (target > 0)).mean() > 0.97
    monkeypatch.setattr(s, "STEPS", 1)
    one = s.Trainer(rows, 2, lambda m: [m])
    one.walk(target, np.ones_like(target), 0, 10_000)
    two = _lockstep([rows[:300], rows[300:]], [target[:300], target[300:]], 1, 10_000)[0]
    for k in one.p:
        assert np.allclose(one.p[k], two.p[k], atol=1e-4)
