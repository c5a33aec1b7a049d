"""Evaluation passages inside training text.

A generalised suffix automaton holds all word sequences of the normalised test items.  Every document is streamed
through it word by word, tracking the longest match that ends at each word; matches of at least ``seed_words(least,
one_in)`` words name the items they come from: every stretch within the limits holds an exact run that long (of 16 words
with one edit in eight: 14 unchanged words in at most 3 runs, hence 5), so no case is lost there.  The matches of a
document with an item are then chained exactly: runs joined over gaps whose word edit distance counts as edits, until some
chain spans ``least`` words of the passage with few enough edits.

Plan: documents are scanned once, without shuffle; the items lie as a table in the shared folder, from which each Python
worker builds the automaton once.  Items beyond ``MAX_CHARS`` characters are dealt to several automata, each of bounded
size, and the documents are scanned once per automaton.  No item passes through the driver or the plan.
"""

from __future__ import annotations

import bisect
import html
import re
import unicodedata

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from kinelake.session import materialise

LEAST = 16
ONE_IN = 8
#: Characters of the items in one automaton: about 120 MB in a Python worker (measured: 740 bytes a word).
MAX_CHARS = 1 << 20
STRETCHES = "array<struct<first_word:long,last_word:long,first_char:long,end_char:long>>"
FOUND = f"doc_id long, item_id long, n_words long, n_edits long, first_word long, last_word long, n_doc_words long, stretches {STRETCHES}"

_WORD = re.compile(r"[^\W_]+(?:['’ʼ‘`´][^\W_]+)*")
_APOSTROPHE = re.compile(r"['’ʼ‘`´]")
_INLINE = re.compile(r"</?(?:b|i|u|s|em|strong|span|font|a|mark|sub|sup|small|code|wbr)(?:\s[^<>]*)?/?>", re.I)
_TAG = re.compile(r"<!--.*?-->|</?[a-z][^<>]*>", re.I | re.S)
_INVISIBLE = re.compile("[­​-‏⁠﻿]")
_HYPHENATED = re.compile(r"(?<=[^\W\d_])[-‐‑][ \t]*\r?\n[ \t>*|#]*(?=[^\W\d_])")


def words(text: str | None) -> list[str]:
    """Words without regard to case, punctuation, spacing, line breaks (also inside a word), markup and Unicode form."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", _INLINE.sub("", text))
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
    if "\n" in text:
        text = _HYPHENATED.sub("", text)
    out = _WORD.findall(text.casefold())
    if not text.isascii():
        out = ["".join(c for c in unicodedata.normalize("NFD", w) if not unicodedata.combining(c)) for w in out]
    return [_APOSTROPHE.sub("", w) if not w.isalnum() else w for w in out]


_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)")
#: A character below 128 never joins with what stands before it.
_PIECES = re.compile(r"[\x00-\x7f][^\x00-\x7f]*|[^\x00-\x7f]+")


def word_spans(text: str | None) -> list[tuple[int, int]]:
    """Start and end in ``text`` of every word of :func:`words`; the same steps, with the origin of every character."""
    if not text:
        return []
    chars, at = text, [(i, i + 1) for i in range(len(text))]

    def put(pattern, new):
        nonlocal chars, at
        out, origin, upto = [], [], 0
        for m in pattern.finditer(chars):
            a, b = m.span()
            w = new(m.group())
            out += [chars[upto:a], w]
            origin += at[upto:a] + [(at[a][0], at[b - 1][1])] * len(w)
            upto = b
        chars, at = "".join([*out, chars[upto:]]), origin + at[upto:]

    if "&" in chars:
        put(_REFERENCE, html.unescape)
    if "<" in chars:
        put(_INLINE, lambda _: "")
        put(_TAG, lambda _: " ")
    if not chars.isascii():
        out, origin = [], []
        for m in _PIECES.finditer(chars):
            whole, groups, i = unicodedata.normalize("NFKC", m.group()), [], m.start()
            for c in m.group():
                groups.append([c, *at[i]]) if not groups or not unicodedata.combining(c) else groups.__setitem__(-1, [groups[-1][0] + c, groups[-1][1], at[i][1]])
                i += 1
            groups = [(unicodedata.normalize("NFKC", c), x, y) for c, x, y in groups]
            if "".join(c for c, _, _ in groups) != whole:
                groups = [(whole, at[m.start()][0], at[m.end() - 1][1])]
            out += [c for c, _, _ in groups]
            origin += [(x, y) for c, x, y in groups for _ in c]
        chars, at = "".join(out), origin
        put(_INVISIBLE, lambda _: "")
    if "\n" in chars:
        put(_HYPHENATED, lambda _: "")
    out, origin = [], []
    for c, o in zip(chars, at):
        folded = c.casefold()
        out.append(folded)
        origin += [o] * len(folded)
    return [(origin[m.start()][0], origin[m.end() - 1][1]) for m in _WORD.finditer("".join(out))]


def seed_words(least: int = LEAST, one_in: int = ONE_IN) -> int:
    """The exact run that every stretch of at least ``least`` words with at most one edit in ``one_in`` must hold: e edits
    leave the unchanged words in at most e + 1 runs.  ValueError where no run of two words is sure."""
    if least < 1 or one_in < 1:
        raise ValueError("least and one_in must be positive")
    # The bound grows from one multiple of one_in to the next, so the shortest stretches decide.
    longest = min(-(-(n - n // one_in) // (n // one_in + 1)) for n in range(least, least + 2 * one_in + 1))
    if longest < 2:
        raise ValueError(f"{least} words with one edit in {one_in} need not hold two words in a row")
    return longest


class Automaton:
    """Generalised suffix automaton over word numbers; every state of at least ``seed`` words knows where it ends."""

    def __init__(self, items: list[tuple[int, list[str]]], seed: int = 5):
        self.seed = seed
        self.number: dict[str, int] = {}
        self.go: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: list[list[int]] = []
        ends: list[tuple[int, int, int]] = []
        for k, (_, tokens) in enumerate(items):
            last = 0
            for p, w in enumerate(tokens):
                last = self._extend(last, self.number.setdefault(w, len(self.number)))
                ends.append((last, k, p))
            self.items.append([self.number[w] for w in tokens])
        self.ends: dict[int, list[tuple[int, int]]] = {}
        for state, k, p in ends:
            while state > 0 and self.length[state] >= seed:
                self.ends.setdefault(state, []).append((k, p))
                state = self.link[state]

    def _extend(self, last: int, c: int) -> int:
        go, link, length = self.go, self.link, self.length
        if c in go[last]:
            q = go[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, q, c)
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
        return new

    def _clone(self, p: int, q: int, c: int) -> int:
        go, link, length = self.go, self.link, self.length
        copy = len(go)
        go.append(dict(go[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and go[p].get(c) == q:
            go[p][c] = copy
            p = link[p]
        return copy

    def matches(self, tokens: list[str]):
        """(item, position in the item, position in the text, length) of the maximal matches of at least ``seed`` words.

        A match of one item can end inside a longer one of another, so every item that ends at a word is compared with
        the next word of the text, not only where the longest match breaks."""
        number, go, link, length, items = self.number.get, self.go, self.link, self.length, self.items
        numbers = [number(w) for w in tokens]
        state, run = 0, 0
        for i, c in enumerate(numbers):
            step = None
            while c is not None and (step := go[state].get(c)) is None and state > 0:
                state = link[state]
                run = length[state]
            state, run = (0, 0) if step is None else (step, run + 1)
            if run < self.seed:
                continue
            after = numbers[i + 1] if i + 1 < len(numbers) else None
            # The states above on the suffix links hold the items with which only the end of the match is shared.
            seen = set()
            u, n = state, run
            while u > 0 and length[u] >= self.seed:
                for k, p in self.ends.get(u, ()):
                    if (k, p) not in seen:
                        seen.add((k, p))
                        if after is None or p + 1 == len(items[k]) or items[k][p + 1] != after:
                            yield k, p - n + 1, i - n + 1, n
                u = link[u]
                n = length[u]


def edit_distance(a: list[str], b: list[str]) -> int:
    if not a or not b:
        return len(a) or len(b)
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def _single_words(passage: list[str], text: list[str], p: int, t: int, step: int, hops: int = 2) -> list[tuple[int, int, int]]:
    """What a chain that ends next to (p, t) can gain from single unchanged words beyond an edit: (passage words, edits,
    text position of the last word).  ``step`` is +1 to the right, -1 to the left."""
    out = []
    for dp in range(4):
        for dt in range(4):
            q, u = p + step * dp, t + step * dt
            if dp + dt and 0 <= q < len(passage) and 0 <= u < len(text) and passage[q] == text[u]:
                a, b = (passage[p:q], text[t:u]) if step > 0 else (passage[q + 1 : p + 1], text[u + 1 : t + 1])
                here = (dp + 1, edit_distance(a, b), u)
                out.append(here)
                if hops > 1:
                    out += [(here[0] + n, here[1] + e, v) for n, e, v in _single_words(passage, text, q + step, u + step, step, hops - 1)]
    return out


def best_stretch(passage: list[str], text: list[str], least: int = LEAST, one_in: int = ONE_IN) -> tuple[int, int, int, int] | None:
    """The longest of :func:`stretches`; None if there is none."""
    return next(iter(stretches(passage, text, least, one_in)), None)


def stretches(passage: list[str], text: list[str], least: int = LEAST, one_in: int = ONE_IN) -> list[tuple[int, int, int, int]]:
    """(words, edits, first and last text position) of the stretches of the passage in the text that have at least
    ``least`` words and at most one edit in ``one_in``: the longest, then the longest that does not touch it, and so on.

    Runs of at least two words are chained in order; the gap between two runs costs its edit distance.  At either end up
    to two single unchanged words beyond an edit can join the chain."""
    at: dict[tuple[str, str], list[int]] = {}
    for p in range(len(passage) - 1):
        at.setdefault((passage[p], passage[p + 1]), []).append(p)
    runs, open_runs = [], {}
    for t in range(len(text) - 1):
        here = {}
        for p in at.get((text[t], text[t + 1]), ()):
            r = open_runs.get(p - 1)
            if r is None:
                r = [t, p, 1]
                runs.append(r)
            r[2] += 1
            here[p] = r
        open_runs = here
    gap = max(4, len(passage) // one_in + 2)
    good = set()
    fronts = []
    runs.sort()
    for k, (t, p, n) in enumerate(runs):
        front = [(n, 0, t, p)]
        for m in range(k - 1, -1, -1):
            t0, p0, n0 = runs[m]
            if t - t0 - n0 > gap + 8 and t - t0 > 2 * len(passage) + 16:
                break
            for back in range(min(n0 - 1, max(0, t0 + n0 - t, p0 + n0 - p)) + 1):
                te, pe = t0 + n0 - back, p0 + n0 - back
                if back and back < max(t0 + n0 - t, p0 + n0 - p):
                    continue
                if te > t or pe > p or t - te > gap or p - pe > gap:
                    continue
                cost = edit_distance(passage[pe:p], text[te:t])
                for length, edits, *start in fronts[m]:
                    front.append((length - back + p - pe + n, edits + cost, *start))
        kept = []
        for x in sorted(front, key=lambda x: (-x[0], x[1])):
            if all(y[1] > x[1] for y in kept):
                kept.append(x)
        fronts.append(kept)
        right = None
        for length, edits, t0, p0 in kept:
            ends = [(length, edits, t0, t + n - 1)]
            # Ends matter where they can lift a chain over the bar; every edit needs ``one_in`` words.
            if length + 16 >= least and (length < least or edits * one_in > length):
                right = _single_words(passage, text, p + n, t + n, 1) if right is None else right
                left = _single_words(passage, text, p0 - 1, t0 - 1, -1)
                ends += [(length + a + b, edits + c + d, u, v) for a, c, v in [(0, 0, t + n - 1), *right] for b, d, u in [(0, 0, t0), *left] if a or b]
            for x in ends:
                if x[0] >= least and x[1] * one_in <= x[0]:
                    good.add(x)
    chosen: list[tuple[int, int]] = []
    out = []
    for x in sorted(good, key=lambda x: (-x[0], x[1], x[2], x[3])):
        i = bisect.bisect(chosen, (x[2], x[3]))
        if (i == 0 or chosen[i - 1][1] < x[2]) and (i == len(chosen) or x[3] < chosen[i][0]):
            chosen.insert(i, (x[2], x[3]))
            out.append(x)
    return out


_BUILT: dict = {}


def _automaton(path: str, part: int, seed: int):
    """The automaton over one part of the items' table, built once per worker."""
    key = (path, part, seed)
    if key not in _BUILT:
        _BUILT.clear()
        uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file:///") else path
        system, folder = pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)
        rows = ds.dataset(folder, filesystem=system, format="parquet").to_table(columns=["item_id", "passage"], filter=ds.field("part") == part)
        tokens = [(i, words(p)) for i, p in sorted(zip(rows.column("item_id").to_pylist(), rows.column("passage").to_pylist()))]
        _BUILT[key] = (Automaton(tokens, seed), tokens)
    return _BUILT[key]


def _hits(machine: Automaton, passages: list, tokens: list[str], least: int, one_in: int) -> dict[int, list[tuple[int, int, int, int]]]:
    near: dict[int, list[int]] = {}
    for k, _, t, n in machine.matches(tokens):
        lo, hi = near.get(k, (t, t + n))
        near[k] = (min(lo, t), max(hi, t + n))
    out = {}
    for k, (lo, hi) in near.items():
        around = 2 * len(passages[k][1])
        base = max(0, lo - around)
        if hit := stretches(passages[k][1], tokens[base : hi + around], least, one_in):
            out[k] = [(n, e, base + a, base + b) for n, e, a, b in hit]
    return out


def _scan(path: str, part: int, least: int, one_in: int, batches):
    machine, passages = _automaton(path, part, seed_words(least, one_in))
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            tokens = words(text)
            hits = _hits(machine, passages, tokens, least, one_in)
            if not hits:
                continue
            spans = {k: [(a, b) for _, _, a, b in hit] for k, hit in hits.items()}
            # Until nothing is left, also where the text closes up over a cut; what only then arises goes to the first item.
            left, more = list(range(len(tokens))), spans
            while more:
                gone = {i for span in more.values() for a, b in span for i in range(a, b + 1)}
                left = [i for i in left if i not in gone]
                more = {k: [(left[a], left[b]) for _, _, a, b in hit] for k, hit in _hits(machine, passages, [tokens[i] for i in left], least, one_in).items()}
                for k, span in more.items():
                    spans[k if k in spans else next(iter(spans))] += span
            at = word_spans(text)
            for k, hit in hits.items():
                n, e, a, b = hit[0]
                cut = [{"first_word": x, "last_word": y, "first_char": at[x][0], "end_char": at[y][1]} for x, y in sorted(spans[k])]
                rows.append((doc, passages[k][0], n, e, a, b, len(tokens), cut))
        if rows:
            *numbers, cuts = zip(*rows)
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("first_word", "last_word", "first_char", "end_char")]))
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in numbers], pa.array(cuts, kind)], names=["doc_id", "item_id", "n_words", "n_edits", "first_word", "last_word", "n_doc_words", "stretches"])


def leaked_passages(documents: DataFrame, items: DataFrame, least: int = LEAST, one_in: int = ONE_IN, max_chars: int = MAX_CHARS) -> DataFrame:
    """One row per document and item whose passage the document holds, whole or in part, with the longest such stretch:
    its words, edits, first and last word in the document, the document's words (for coverage), and ``stretches``: all
    that a cut takes out for the item, by words and by characters of the text (``end_char`` excluded).

    ``least`` and ``one_in`` must leave two words in a row in every stretch (ValueError otherwise).  Null or empty texts
    and passages match nothing; passages shorter than ``least`` words cannot match.  A document or
    item delivered several times gives one row.  Whole texts are scanned; other columns are ignored."""
    seed_words(least, one_in)  # refuses what cannot be searched
    given = items.where("item_id is not null and passage is not null").select(F.col("item_id").cast("long").alias("item_id"), "passage").distinct()
    chars = given.agg(F.coalesce(F.sum(F.length("passage")), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-int(chars) // max_chars))
    _, path = materialise(given.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(parts)).cast("long")).repartition(parts, "part"), "leak-items")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    out = None
    for part in range(parts):
        one = docs.mapInArrow(_scanner(path, part, least, one_in), FOUND)
        out = one if out is None else out.unionByName(one)
    # A few rows: one per leak.
    return out.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("n_words", "n_edits", "first_word", "last_word", "n_doc_words", "stretches"), F.struct("n_words", -F.col("n_edits"), -F.col("first_word"))).alias("s")).select("doc_id", "item_id", "s.*")


def _scanner(path, part, least, one_in):
    return lambda batches: _scan(path, part, least, one_in, batches)


def cut_leaks(documents: DataFrame, leaks: DataFrame, max_coverage: float = 0.5) -> DataFrame:
    """Documents with ``leak_action``: ``drop`` where leaked spans cover more than ``max_coverage`` of the words, ``cut``
    with the spans in ``leak_spans`` where they cover less, null where there is no leak.  ``cut_text`` is the text without
    the characters of the spans (markup inside them goes too), the text itself where there is no leak, null for ``drop``.

    A ``doc_id`` stands for one text.  Where the items fill several automata, what arises only as the text closes up over
    a passage of another automaton is not cut."""
    spans = leaks.groupBy("doc_id").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("stretches")))).alias("leak_spans"), F.max("n_doc_words").alias("_n"))
    start = F.struct(F.lit(0).cast("long").alias("covered"), F.lit(-1).cast("long").alias("upto"))
    merged = F.aggregate("leak_spans", start, lambda acc, s: F.struct((acc["covered"] + F.greatest(F.lit(0), s["last_word"] - F.greatest(s["first_word"] - 1, acc["upto"]))).alias("covered"), F.greatest(acc["upto"], s["last_word"]).alias("upto")))
    spans = spans.withColumn("leak_coverage", merged["covered"] / F.greatest(F.col("_n"), F.lit(1))).drop("_n")
    rows = documents.join(spans, "doc_id", "left").withColumn("leak_action", F.when(F.col("leak_coverage") > max_coverage, "drop").when(F.col("leak_coverage") > 0, "cut"))
    part = lambda a, n: F.col("text").substr((a + 1).cast("int"), F.greatest(F.lit(0), n).cast("int"))
    begin = F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("upto"))
    kept = F.aggregate("leak_spans", begin, lambda acc, s: F.struct(F.concat(acc["kept"], part(acc["upto"], s["first_char"] - acc["upto"])).alias("kept"), F.greatest(acc["upto"], s["end_char"]).alias("upto")), lambda acc: F.concat(acc["kept"], part(acc["upto"], F.length("text").cast("long"))))
    return rows.withColumn("cut_text", F.when(F.col("leak_action") == "cut", kept).when(F.col("leak_action").isNull(), F.col("text")))


def p7_leaks(spark: SparkSession, root: str) -> DataFrame:
    return leaked_passages(spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/eval_items.parquet"))


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    """Documents that hold a stretch of an item's passage."""
    return p7_leaks(spark, root).select("doc_id", "item_id")


def p7_cut(spark: SparkSession, root: str) -> DataFrame:
    """All documents with what is done about their leaks, and the text that is left (null: dropped)."""
    return cut_leaks(spark.read.parquet(f"{root}/documents.parquet"), p7_leaks(spark, root)).select("doc_id", "leak_action", "leak_coverage", "leak_spans", "cut_text")


QUERIES = {"p7_found": p7_found, "p7_leaks": p7_leaks, "p7_cut": p7_cut}
ORACLES: dict[str, str] = {}
