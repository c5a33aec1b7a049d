"""Mixing sources to target shares of all tokens, with integral repeats by pivotal rounding.

Each source's expected copies per record follow from its target, its tokens and its cap; what a capped or empty source
cannot supply goes to the others in proportion to their shares.  The integral part is given to every record; the
fractional parts are rounded by the pivotal method: two records transfer probability to each other at random until one of
them is settled at 0 or 1.  The sum of the fractions is kept, and because records meet in order of size, so are the
tokens.  Records of a source are dealt to groups of about ``GROUP`` by hash, each group leaves at most one unsettled
record, and these are combined by the same step in a reduction tree with fan-in ``FAN_IN``, one last draw per source.

All draws are functions of the seed and the record, so a repeated task gives the same result.  The driver sees one row
per target, whose table is fixed.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kinelake.session import materialise

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The public pre-tokenisation pattern of this vocabulary; a fixed value.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PATTERN = regex.compile(PATTERN)
GROUP = 10_000
FAN_IN = 64
PIECE = 20_000
MIX = "doc_id long, source string, n_tokens long, repeats long, open double, bucket long"

_ENCODINGS: dict = {}


def encoding(path: str):
    """The tokenizer of a ``.tiktoken`` file, loaded once per process."""
    if path not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def pieces(text: str) -> Iterator[str]:
    """The text in parts of about ``PIECE`` characters that are tokenized as in the whole: cut between two of the pattern's
    tokens of which the first is no white space (white space looks at what follows)."""
    begin = last = 0
    for m in _PATTERN.finditer(text):
        if m.end() - begin > PIECE and last > begin:
            yield text[begin:last]
            begin = last
        if not m.group()[-1].isspace():
            last = m.end()
    yield text[begin:]


def merged(data: bytes, ranks: dict[bytes, int]) -> int:
    """How many tokens byte pair encoding leaves of one long word: always the pair of least rank, the leftmost first.  A
    heap keeps this at n log n."""
    n = len(data)
    if n < 2 or data in ranks:
        return min(n, 1)
    end = list(range(1, n + 1))  # the part that begins at i ends at end[i]
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, upto = heapq.heappop(heap)
        j = end[i] if alive[i] else n
        if j >= n or end[j] != upto:
            continue  # one of the two has been merged since
        end[i], alive[j] = upto, False
        left -= 1
        if upto < n:
            before[upto] = i
            if (r := ranks.get(data[i : end[upto]])) is not None:
                heapq.heappush(heap, (r, i, end[upto]))
        if (h := before[i]) >= 0 and (r := ranks.get(data[h:upto])) is not None:
            heapq.heappush(heap, (r, h, upto))
    return left


def count_tokens(tokenizer, text: str) -> int:
    """The number of tokens of the whole text."""
    if len(text) <= PIECE:
        return len(tokenizer.encode_ordinary(text))
    n = 0
    for p in pieces(text):
        if len(p) <= 2 * PIECE:
            n += len(tokenizer.encode_ordinary(p))
        else:  # holds a word of more than PIECE characters
            n += sum(merged(w.group().encode(), tokenizer._mergeable_ranks) if len(w.group()) > 1_000 else len(tokenizer.encode_ordinary(w.group())) for w in _PATTERN.finditer(p))
    return n


def _count(path: str, batches):
    tokenizer = encoding(path)
    for batch in batches:
        texts = batch.column(2).to_pylist()
        counts = [count_tokens(tokenizer, t) if t else 0 for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "source", "n_tokens"])


def source_key(source: Column) -> Column:
    """A source in any spelling; null for null and blank."""
    key = F.regexp_replace(F.lower(F.trim(source)), r"[^\p{L}\p{N}]+", "_")
    return F.nullif(F.regexp_replace(key, "^_+|_+$", ""), F.lit(""))


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, n_tokens), one row per row of ``documents``; ``source`` as key, null and empty texts count 0."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), source_key(F.col("source")).alias("source"), "text")
    return rows.mapInArrow(lambda it: _count(tokenizer, it), "doc_id long, source string, n_tokens long")


def allocate(targets: list[tuple[str, float, int]], have: dict[str, int], total: float) -> dict[str, float]:
    """Tokens for each target (source, share, max repeats) from ``have``: shares of ``total``, capped at what the source
    can supply; the shortfall goes to the uncapped sources in proportion to their shares, as far as they can supply it."""
    cap = {s: float(have.get(s, 0)) * max(0, r) for s, _, r in targets}
    share = {s: x for s, x, _ in targets}
    got = {s: 0.0 for s in share}
    free = {s for s in share if cap[s] > 0 and share[s] > 0}
    left = total * sum(share.values()) if sum(share.values()) < 1 - 1e-9 else total
    while free and left > 1e-9:
        whole = sum(share[s] for s in free)
        full = {s for s in free if share[s] / whole * left >= cap[s] - 1e-9}
        if not full:
            for s in free:
                got[s] = share[s] / whole * left
            break
        for s in full:
            got[s] = cap[s]
        left -= sum(cap[s] for s in full)
        free -= full
    return got


def settle(rows: list[list], seed: int) -> None:
    """Pivotal rounding of ``rows`` ([doc_id, n_tokens, open, repeats]) in their order, in place: each ``open`` becomes 0
    (``repeats`` + 0 or 1), but for at most one row."""
    held = None
    for row in rows:
        if not 0 < row[2] < 1:
            row[3] += int(round(row[2]))
            row[2] = 0.0
            continue
        if held is None:
            held = row
            continue
        a, b = held[2], row[2]
        u = xxhash.xxh64_intdigest(f"{held[0]},{row[0]}", seed) / 2**64
        if a + b < 1 - 1e-12:
            winner, loser = (held, row) if u * (a + b) < a else (row, held)
            loser[2], winner[2] = 0.0, a + b
            held = winner
        else:
            # One of the two is taken; the other keeps what exceeds 1.
            winner, loser = (held, row) if u * (2 - a - b) < 1 - b else (row, held)
            rest = a + b - 1
            winner[3] += 1
            winner[2] = 0.0
            loser[2] = rest if rest > 1e-12 else 0.0
            held = loser if loser[2] else None
    if held is not None and held[2] > 1 - 1e-12:
        held[3] += 1
        held[2] = 0.0


def _level(seed: int, last: bool):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_tokens", "ascending"), ("doc_id", "ascending")])
        rows = [list(r) for r in zip(*(table.column(c).to_pylist() for c in ("doc_id", "n_tokens", "open", "repeats")))]
        settle(rows, seed)
        if last:
            for r in rows:
                if r[2] > 0:
                    r[3] += int(xxhash.xxh64_intdigest(f"{r[0]}", seed) / 2**64 < r[2])
                    r[2] = 0.0
        return pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "source": table.column("source"), "n_tokens": pa.array([r[1] for r in rows], pa.int64()), "repeats": pa.array([r[3] for r in rows], pa.int64()), "open": pa.array([float(r[2]) for r in rows]), "bucket": table.column("bucket")})

    return run


def mix(documents: DataFrame, targets: DataFrame, total_tokens: float | None = None, tokenizer: str = TOKENIZER, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """(repeats, report).

    repeats: (doc_id, source, n_tokens, repeats), one row per row of ``documents``; a record of a source without target
    (or without source) gets 0.  report: one row per source of either table with target, tokens available and drawn, the
    share reached and ``status`` (met, capped, no documents, no target).

    ``total_tokens`` is the size aimed at, by default the tokens of all sources that have a target.  Targets with null
    source, share or cap are ignored, a source listed twice counts once (the larger share); a record of 0 tokens is
    drawn like any other.  Empty tables give empty results."""
    spark = documents.sparkSession
    counted, _ = materialise(token_counts(documents, tokenizer), "token-counts")
    wanted = targets.where("source is not null and target_share is not null and max_repeats is not null").select(source_key(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("share"), F.col("max_repeats").cast("long").alias("cap"))
    plan = [(r["source"], r["share"], r["cap"]) for r in wanted.groupBy("source").agg(F.max("share").alias("share"), F.max("cap").alias("cap")).orderBy("source").collect()]  # a fixed table
    sizes = counted.where(F.col("source").isin([s for s, _, _ in plan])).groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")).collect()
    have, n = {r["source"]: r["tokens"] for r in sizes}, {r["source"]: r["n"] for r in sizes}
    total = float(sum(have.values())) if total_tokens is None else float(total_tokens)
    got = allocate(plan, have, total)
    per = []
    for s, _, cap in plan:
        copies = min(float(cap), got[s] / have[s]) if have.get(s) else 0.0
        whole = int(copies + 1e-9)
        per.append((s, whole, max(0.0, copies - whole) if copies - whole > 1e-9 else 0.0, -(-n.get(s, 1) // GROUP)))
    rates = spark.createDataFrame(per, "source string, whole long, fraction double, groups long")
    # One row per target: a fixed size.
    dealt = counted.join(F.broadcast(rates), "source", "left").withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.coalesce("groups", F.lit(1))))
    dealt = dealt.select("doc_id", "source", "n_tokens", F.coalesce("whole", F.lit(0)).alias("repeats"), F.coalesce("fraction", F.lit(0.0)).alias("open"), "bucket")
    settled = [dealt.where("open = 0")]
    live, groups, level = dealt.where("open > 0"), max([g for *_, g in per], default=1), 0
    while True:
        last = groups <= 1
        step = live.groupBy("source", "bucket").applyInArrow(_level(seed + level, last), MIX)
        step, _ = materialise(step, "mix-level")
        settled.append(step.where("open = 0"))
        if last:
            break
        live = step.where("open > 0").withColumn("bucket", F.floor(F.col("bucket") / FAN_IN).cast("long"))
        groups, level = -(-groups // FAN_IN), level + 1
    repeats = settled[0]
    for x in settled[1:]:
        repeats = repeats.unionByName(x)
    repeats = repeats.select("doc_id", "source", "n_tokens", "repeats")
    drawn = repeats.groupBy("source").agg(F.count("*").alias("n_documents"), F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("drawn_tokens"), F.max("repeats").alias("most_repeats"))
    all_drawn = drawn.agg(F.coalesce(F.sum("drawn_tokens"), F.lit(0)).alias("t"))
    aims = spark.createDataFrame([(s, x, c, got[s]) for s, x, c in plan], "source string, target_share double, max_repeats long, aimed_tokens double")
    joined = drawn.join(F.broadcast(aims), "source", "full")
    joined = joined.withColumn("t", F.lit(all_drawn.first()["t"]))  # one row
    status = F.when(F.col("target_share").isNull(), "no target").when(F.coalesce("n_tokens", F.lit(0)) == 0, "no documents").when(F.col("aimed_tokens") >= F.col("n_tokens") * F.col("max_repeats") - 1e-6, "capped").otherwise("met")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    report = joined.select("source", "target_share", "max_repeats", zero("n_documents"), zero("n_tokens"), zero("drawn_tokens"), zero("most_repeats"), (F.coalesce("drawn_tokens", F.lit(0)) / F.greatest(F.col("t"), F.lit(1))).alias("reached_share"), status.alias("status"))
    return repeats, report


def p8_mix(spark: SparkSession, root: str) -> DataFrame:
    """How often each document is drawn."""
    return mix(spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/mix_targets.parquet"))[0]


def p8_shares(spark: SparkSession, root: str) -> DataFrame:
    """The share of all tokens that each source reaches."""
    return mix(spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/mix_targets.parquet"))[1]


QUERIES = {"p8_mix": p8_mix, "p8_shares": p8_shares}
ORACLES: dict[str, str] = {}
