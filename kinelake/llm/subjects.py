"""Subject areas of documents: averaged word and subword embeddings with independent logistic outputs.

A word's vector is the mean of its own and its subwords' embeddings (both hashed into fixed tables), a sentence's vector
the mean of its words' vectors; each subject has its own logistic output, so a sentence may treat several or none.  One
more output recognises quoted evaluation passages, for which the test items are the positive examples.

Training: the sentences of the labelled documents are dealt to partitions that are held in one barrier stage.  In every
step each partition computes the gradient of its share of the batch, the gradients of all partitions are gathered and
summed, and every partition takes the same step, so all hold the same parameters throughout.  Sentences first inherit
their document's labels; later phases let each sentence keep only the labels its own score supports, so that neutral
sentences and wrong labels stop counting.  The sample is bounded by ``max_docs`` labelled documents and as many quoted
passages (the lowest hashes); the parameters have a fixed size, whatever the corpus.

Scoring: every document, whole, in one scan: own sentences are those that are no log line, code, heading, boilerplate or
quotation.  Boilerplate is found over all documents as lines that keep closing documents (a hash aggregation).  A
document treats a subject if at least a quarter of its own sentences do.
"""

from __future__ import annotations

import functools
import hashlib
import html
import json
import re
import secrets
import socket
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from kinelake.session import drop_folder, materialise

BUCKETS = 1 << 14
DIM = 16
MAX_DOCS = 6_000
#: Partitions that train together; the cluster must run so many tasks at once.
PARTS = 4
#: Sentences a step takes from all partitions together, fewer where a round would have less than ``STEPS`` steps.
BATCH = 256
STEPS = 100
ROUNDS = (8, 6, 6)
#: Stands for "a quoted passage" among the labels.
QUOTED = -1
SHARE = 0.25
THRESHOLD = 0.5

_WORD = re.compile(r"[^\W\d_]+")
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_MARKER = re.compile(r"^\s*(?:\[\d{1,3}:\d\d(?::\d\d)?\]|[-*>#+|]+|\d+[.)])\s*")
_SPLIT = re.compile(r"(?<=[.!?…])[\"'”’)\]]*\s+")
_PAIR = re.compile(r"^\S*=\S*$")
_OPTION = re.compile(r"(?:^|\s)--?[a-z][\w-]*")


def own_lines(text: str | None) -> list[str]:
    """Lines without markup, line markers, fenced code, log lines and commands."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    out, code = [], False
    for raw in text.splitlines():
        line = raw
        while (m := _MARKER.match(line)) and m.end():
            if line.lstrip().startswith("#"):
                line = ""  # a heading
                break
            line = line[m.end() :]
        line = " ".join(line.split())
        if line.startswith("```") or line.startswith("~~~"):
            code = not code
            continue
        if code:
            continue
        parts = line.split()
        if parts and (sum(bool(_PAIR.match(p)) for p in parts) * 2 >= len(parts) or len(_OPTION.findall(line)) >= 2):
            continue
        out.append(line)
    return out


def line_key(line: str) -> str:
    """A line as it is compared over the corpus."""
    return " ".join(line.casefold().split())


def sentences(text: str | None, skip: set[str]) -> list[list[str]]:
    """The words of each own sentence.  Lines in ``skip`` (as keys) are left out; a line break inside a sentence does not
    end it; a remark of fewer than four words belongs to the sentence before; what has no end mark is no sentence unless
    it closes a paragraph with at least eight words."""
    paragraph, paragraphs = [], []
    for line in own_lines(text):
        if not line or line_key(line) in skip:
            if paragraph:
                paragraphs.append(" ".join(paragraph))
            paragraph = []
        else:
            paragraph.append(line)
    if paragraph:
        paragraphs.append(" ".join(paragraph))
    out: list[list[str]] = []
    for p in paragraphs:
        for s in _SPLIT.split(p):
            w = _WORD.findall(s.lower())
            ended = s.rstrip("\"'”’)] ")[-1:] in ".!?…"
            if not w or (not ended and len(w) < 8):
                continue
            if len(w) < 4 and out:
                out[-1] = out[-1] + w
            elif len(w) >= 3:
                out.append(w)
    return out


@functools.lru_cache(maxsize=200_000)
def features(word: str) -> np.ndarray:
    """Rows of the embedding table: the word, then its subwords of 3 to 5 letters with word ends."""
    bounded = f"<{word}>"
    rows = [zlib.crc32(word.encode()) % BUCKETS]
    for n in (3, 4, 5):
        rows += [BUCKETS + zlib.crc32(bounded[i : i + n].encode()) % BUCKETS for i in range(len(bounded) - n + 1)]
    return np.array(rows)


class Sparse:
    """Row means over ragged index lists, and the transposed product."""

    def __init__(self, lists: list[np.ndarray], width: int):
        self.length = np.array([len(x) for x in lists])
        self.column = np.concatenate(lists) if lists else np.zeros(0, int)
        self.row = np.repeat(np.arange(len(lists)), self.length)
        self.start = np.concatenate(([0], np.cumsum(self.length)))
        self.width = width

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The columns of ``rows``, one after the other, and the place in ``rows`` that each belongs to."""
        n = self.length[rows]
        at = np.repeat(self.start[rows] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        return self.column[at], np.repeat(np.arange(len(rows)), n)

    def mean(self, table: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        if rows is None:
            return np.add.reduceat(table[self.column], self.start[:-1], axis=0) / self.length[:, None]
        column, _ = self.take(rows)
        n = self.length[rows]
        return np.add.reduceat(table[column], np.concatenate(([0], np.cumsum(n)[:-1])), axis=0) / n[:, None]

    def spread(self, gradient: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct columns of ``rows``, and what each takes of the gradients of the rows' means."""
        column, owner = self.take(rows)
        columns, place = np.unique(column, return_inverse=True)
        scaled = (gradient / self.length[rows][:, None])[owner]
        return columns, np.stack([np.bincount(place, scaled[:, d], minlength=len(columns)) for d in range(gradient.shape[1])], axis=1)


def new_parameters(outputs: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {"e": rng.normal(0, 0.3, (2 * BUCKETS, DIM)), "w": np.zeros((DIM, outputs)), "b": np.full(outputs, -2.0)}


def index_words(rows: list[list[str]]) -> tuple[list[str], list[np.ndarray]]:
    number: dict[str, int] = {}
    lists = [np.array([number.setdefault(w, len(number)) for w in r]) for r in rows]
    return list(number), lists


def word_vectors(vocabulary: list[str], e: np.ndarray) -> np.ndarray:
    return Sparse([features(w) for w in vocabulary], len(e)).mean(e)


class Trainer:
    """Synchronised gradient descent (Adam, on the rows that have a gradient) over the sentences of all partitions.

    ``gather`` takes this partition's message and returns those of all partitions, in their order; alone it is the list of
    the one.  What is exchanged in a step: the summed gradients of the outputs and of the words' vectors, and the number
    of sentences.  Words spread their gradients over their subwords after the sum, alike in every partition."""

    def __init__(self, rows: list[list[str]], outputs: int, gather, seed: int = 7):
        self.gather = gather
        own = sorted({w for r in rows for w in r})
        vocabulary = sorted(set().union(*[m.decode().split() for m in gather(" ".join(own).encode())]))
        number = {w: k for k, w in enumerate(vocabulary)}
        self.n = len(rows)
        self.total = sum(int(m) for m in gather(str(self.n).encode()))
        self.sentences = Sparse([np.array([number[w] for w in r]) for r in rows], len(vocabulary)) if rows else None
        features_of = [features(w) for w in vocabulary]
        self.used = np.unique(np.concatenate(features_of)) if vocabulary else np.zeros(0, int)
        self.words = Sparse([np.searchsorted(self.used, f) for f in features_of], len(self.used)) if vocabulary else None
        self.full = new_parameters(outputs, seed)
        self.p = {"e": self.full["e"][self.used], "w": self.full["w"].copy(), "b": self.full["b"].copy()}
        self.m, self.v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        self.steps = 0

    def parameters(self) -> dict[str, np.ndarray]:
        e = self.full["e"].copy()
        e[self.used] = self.p["e"]
        return {"e": e, "w": self.p["w"], "b": self.p["b"]}

    def scores(self) -> np.ndarray:
        if not self.n:
            return np.zeros((0, len(self.p["b"])))
        x = self.sentences.mean(self.words.mean(self.p["e"]))
        return 1 / (1 + np.exp(-(x @ self.p["w"] + self.p["b"])))

    def summed(self, values: np.ndarray) -> np.ndarray:
        """The sum over all partitions."""
        return sum(np.frombuffer(m) for m in self.gather(_joined(values.astype(np.float64)))).reshape(values.shape)

    def _gradient(self, at: np.ndarray, target: np.ndarray, weight: np.ndarray) -> bytes:
        outputs = len(self.p["b"])
        gw, gb, words, gv = np.zeros((DIM, outputs)), np.zeros(outputs), np.zeros(0, int), np.zeros((0, DIM))
        if len(at):
            column, owner = self.sentences.take(at)
            words, place = np.unique(column, return_inverse=True)
            n = self.sentences.length[at]
            x = np.add.reduceat(self.words.mean(self.p["e"], words)[place], np.concatenate(([0], np.cumsum(n)[:-1])), axis=0) / n[:, None]
            g = (1 / (1 + np.exp(-(x @ self.p["w"] + self.p["b"]))) - target[at]) * weight[at]
            gw, gb = x.T @ g, g.sum(0)
            back = ((g @ self.p["w"].T) / n[:, None])[owner]
            gv = np.stack([np.bincount(place, back[:, d], minlength=len(words)) for d in range(DIM)], axis=1)
        return _joined(np.array([len(at)], np.float32), gw.astype(np.float32), gb.astype(np.float32), words.astype(np.int32), gv.astype(np.float32))

    def walk(self, target: np.ndarray, weight: np.ndarray, seed: int, batch: int = BATCH, rate: float = 0.03) -> None:
        """One pass over the sentences; every step takes an equal part of each partition's."""
        outputs = len(self.p["b"])
        order = np.random.default_rng(seed).permutation(self.n)
        batch = max(16, min(batch, self.total // STEPS))
        for at in np.array_split(order, max(1, -(-self.total // batch))):
            n, gradient = 0.0, {"w": np.zeros((DIM, outputs)), "b": np.zeros(outputs)}
            words, vectors = [], []
            for data in self.gather(self._gradient(at, target, weight)):
                head = np.frombuffer(data, "<f4", 1 + (DIM + 1) * outputs).astype(np.float64)
                n += head[0]
                gradient["w"] += head[1 : 1 + DIM * outputs].reshape(DIM, outputs)
                gradient["b"] += head[1 + DIM * outputs :]
                rest = (len(data) - head.size * 4) // (4 + 4 * DIM)
                words.append(np.frombuffer(data, "<i4", rest, head.size * 4))
                vectors.append(np.frombuffer(data, "<f4", rest * DIM, head.size * 4 + rest * 4).reshape(rest, DIM))
            if not n:
                continue
            word, place = np.unique(np.concatenate(words), return_inverse=True)
            every = np.concatenate(vectors)
            sums = np.stack([np.bincount(place, every[:, d], minlength=len(word)) for d in range(DIM)], axis=1)
            # A word's vector is the mean of its rows, so each row takes its share of the word's gradient.
            rows, gradient["e"] = self.words.spread(sums, word)
            self.steps += 1
            for k, g in gradient.items():
                here = rows if k == "e" else slice(None)
                self.m[k][here] = 0.9 * self.m[k][here] + 0.1 * g / n
                self.v[k][here] = 0.99 * self.v[k][here] + 0.01 * (g / n) ** 2
                self.p[k][here] -= rate * (self.m[k][here] / (1 - 0.9**self.steps)) / (np.sqrt(self.v[k][here] / (1 - 0.99**self.steps)) + 1e-8)


def _joined(*arrays: np.ndarray) -> bytes:
    return b"".join(a.tobytes() for a in arrays)


def scores(parameters: dict, rows: list[list[str]]) -> np.ndarray:
    """Probabilities (sentence, output)."""
    if not rows:
        return np.zeros((0, len(parameters["b"])))
    vocabulary, lists = index_words(rows)
    x = Sparse(lists, len(vocabulary)).mean(word_vectors(vocabulary, parameters["e"]))
    return 1 / (1 + np.exp(-(x @ parameters["w"] + parameters["b"])))


def refined(p: np.ndarray, target: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Targets and weights of a later phase, from the scores ``p`` of the sentences, their documents' labels and each
    label's share of all sentences.

    A sentence without subject scores about what the label's share is, so a label stays only where the score is above a
    half, or for rare labels at several times the share; a sure score counts even without the label.  Scores in between
    have no weight."""
    share = np.clip(share, 0.01, 1)
    bar = np.clip(6 * share, 0.2, 0.5)
    own = target > 0
    keep = (own & (p >= bar)) | (~own & (p >= 0.7))
    doubtful = (own & ~keep & (p >= 0.7 * bar)) | (~own & ~keep & (p >= bar))
    return keep.astype(float), 1.0 - doubtful


# ------------------------------------------------------------------------ plan


def _lines(batches):
    for batch in batches:
        seen: dict[str, list[int]] = {}
        for text in batch.column(0).to_pylist():
            keys = [line_key(x) for x in own_lines(text) if x]
            for i, k in enumerate(keys):
                at = seen.setdefault(k, [0, 0])
                at[0] += 1
                at[1] += i == len(keys) - 1
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([int.from_bytes(hashlib.blake2b(k.encode(), digest_size=8).digest(), "big", signed=True) for k in seen], pa.int64()), pa.array([v[0] for v in seen.values()], pa.int64()), pa.array([v[1] for v in seen.values()], pa.int64()), pa.array([k if v[1] else None for k, v in seen.items()], pa.string())],
                names=["h", "n", "n_last", "line"],
            )


def boilerplate(documents: DataFrame, least: int = 5, share: float = 0.001, closing: float = 0.8) -> DataFrame:
    """(line): lines that close at least ``share`` of the documents (and ``least``), in at least ``closing`` of their
    occurrences.  A document has one last line, so there are at most 1 / share rows."""
    texts = documents.select("text").where("text is not null")
    n = texts.count()
    counted = texts.mapInArrow(_lines, "h long, n long, n_last long, line string").groupBy("h").agg(F.sum("n").alias("n"), F.sum("n_last").alias("n_last"), F.max("line").alias("line"))
    return counted.where((F.col("n_last") >= max(least, share * n)) & (F.col("n_last") >= closing * F.col("n"))).select("line")


def _split(skip: frozenset, batches):
    for batch in batches:
        rows = {"part": [], "doc_id": [], "at": [], "labels": [], "words": []}
        for part, doc, labels, text in zip(*(c.to_pylist() for c in batch.columns)):
            for at, w in enumerate(sentences(text, skip)):
                rows["at"].append(at)
                rows["part"].append(part)
                rows["doc_id"].append(doc)
                rows["labels"].append(labels)
                rows["words"].append(w)
        if rows["part"]:
            yield pa.RecordBatch.from_arrays([pa.array(rows["part"], pa.int64()), pa.array(rows["doc_id"], pa.int64()), pa.array(rows["at"], pa.int64()), pa.array(rows["labels"], pa.list_(pa.int64())), pa.array(rows["words"], pa.list_(pa.string()))], names=list(rows))


def _packed(p: dict) -> bytes:
    return b"".join(p[k].astype("<f4").tobytes() for k in ("e", "w", "b"))


def _unpacked(data: bytes, outputs: int) -> dict:
    x = np.frombuffer(data, "<f4").astype(np.float64)
    e, w = 2 * BUCKETS * DIM, DIM * outputs
    return {"e": x[:e].reshape(-1, DIM), "w": x[e : e + w].reshape(DIM, outputs), "b": x[e + w :]}


class Exchange:
    """Gathers messages among the tasks of a barrier stage over sockets to the first task; Spark's own gathering, which
    polls once a second, only tells the tasks where to connect.  A lost task breaks the connections, all tasks fail, and
    Spark runs the stage again as a whole."""

    TIMEOUT = 180

    def __init__(self, context):
        self.rank, size = context.partitionId(), len(context.getTaskInfos())
        self.peers: list[socket.socket] = []
        token = secrets.token_hex(16)
        server = socket.create_server(("", 0), backlog=size) if self.rank == 0 else None
        host = context.getTaskInfos()[self.rank].address.rsplit(":", 1)[0]
        told = json.loads(context.allGather(json.dumps([host, server.getsockname()[1] if server else 0, token]))[0])
        if server:
            server.settimeout(self.TIMEOUT)
            found: dict[int, socket.socket] = {}
            while len(found) < size - 1:
                peer, _ = server.accept()
                self._ready(peer)
                rank, given = json.loads(self._receive(peer))
                if given == token:
                    found[rank] = peer
            server.close()
            self.peers = [found[k] for k in sorted(found)]
        else:
            peer = socket.create_connection((told[0], told[1]), self.TIMEOUT)
            self._ready(peer)
            self._send(peer, json.dumps([self.rank, told[2]]).encode())
            self.peers = [peer]

    def _ready(self, peer) -> None:
        peer.settimeout(self.TIMEOUT)
        peer.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)

    @staticmethod
    def _send(peer, data: bytes) -> None:
        peer.sendall(struct.pack("<q", len(data)) + data)

    @staticmethod
    def _receive(peer) -> bytes:
        def exactly(n):
            out = bytearray()
            while len(out) < n:
                got = peer.recv(min(n - len(out), 1 << 20))
                if not got:
                    raise ConnectionError("a training task was lost")
                out += got
            return bytes(out)

        return exactly(struct.unpack("<q", exactly(8))[0])

    def __call__(self, message: bytes) -> list[bytes]:
        """The messages of all tasks, in their order."""
        if self.rank:
            self._send(self.peers[0], message)
            packed = self._receive(self.peers[0])
        else:
            every = [message, *[self._receive(p) for p in self.peers]]
            packed = struct.pack("<q", len(every)) + b"".join(struct.pack("<q", len(m)) for m in every) + b"".join(every)
            for p in self.peers:
                self._send(p, packed)
        n = struct.unpack_from("<q", packed)[0]
        lengths = struct.unpack_from(f"<{n}q", packed, 8)
        at, out = 8 + 8 * n, []
        for size in lengths:
            out.append(packed[at : at + size])
            at += size
        return out


def _train(subjects: list[int], rounds: tuple, batches):
    """A partition's part in the training; the first one returns the parameters."""
    from pyspark import BarrierTaskContext

    context = BarrierTaskContext.get()
    table = [pa.Table.from_batches([b]) for b in batches]
    rows, labels = [], []
    if table:
        joined = pa.concat_tables(table).sort_by([("doc_id", "ascending"), ("at", "ascending")])
        rows, labels = joined.column("words").to_pylist(), joined.column("labels").to_pylist()
    place = {s: k for k, s in enumerate(subjects)} | {QUOTED: len(subjects)}
    given = np.zeros((len(rows), len(place)))
    for i, own in enumerate(labels):
        given[i, [place[s] for s in own if s in place]] = 1
    trainer = Trainer(rows, len(place), Exchange(context))
    quoted = given[:, -1] > 0
    known = max(1.0, float(trainer.summed(np.array([float((~quoted).sum())]))[0]))
    share = trainer.summed(given[~quoted].sum(0)) / known
    target, weight = given, np.ones_like(given)
    for phase, n in enumerate(rounds):
        if phase:
            p = trainer.scores()
            target, weight = refined(p, given, share)
            target[:, -1], weight[:, -1] = quoted, 1
            weight[~quoted & (p[:, -1] > 0.5), :-1] = 0  # a quotation teaches nothing about subjects
            target[quoted, :-1], weight[quoted, :-1] = 0, 1
        for r in range(n):
            trainer.walk(target, weight, 1000 * phase + 10 * r + context.partitionId())
    if context.partitionId() == 0:
        yield pa.record_batch([pa.array([_packed(trainer.parameters())], pa.binary())], names=["parameters"])


def train(documents: DataFrame, labels: DataFrame, items: DataFrame, subjects: list[int], skip: frozenset, max_docs: int = MAX_DOCS, parts: int = PARTS) -> bytes:
    """The trained parameters (fixed size), from a sample of at most ``max_docs`` labelled documents and ``max_docs``
    quoted passages.  ``parts`` partitions train together, or as many as the session can run at once."""
    given = labels.where("doc_id is not null and subject_id is not null").groupBy("doc_id").agg(F.collect_set("subject_id").alias("labels"))
    sample, sample_path = materialise(given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs), "label-sample")
    spark = documents.sparkSession
    parts = max(1, min(parts, spark.sparkContext.defaultParallelism))
    texts = documents.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("labels").cast("array<long>").alias("labels")), "doc_id")
    passages = items.where("passage is not null").select("passage").distinct().orderBy(F.xxhash64("passage"), "passage").limit(max_docs)
    quotes = passages.select(F.xxhash64("passage").alias("doc_id"), F.col("passage").alias("text"), F.array(F.lit(QUOTED).cast("long")).alias("labels"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("long")
    split = lambda df, lines: df.select(part.alias("part"), "doc_id", "labels", "text").mapInArrow(_splitter(lines), "part long, doc_id long, at long, labels array<long>, words array<string>")
    rows, rows_path = materialise(split(texts, skip).unionByName(split(quotes, frozenset())), "labelled-sentences")
    outputs = len(subjects) + 1
    if sample.isEmpty():
        return _packed(new_parameters(outputs))
    rounds = ROUNDS
    held = rows.repartitionById(parts, F.col("part").cast("int"))
    got = held.mapInArrow(lambda it: _train(subjects, rounds, it), "parameters binary", barrier=True).collect()  # one row
    for path in (sample_path, rows_path):
        drop_folder(spark, path)
    return bytes(got[0]["parameters"])


def _splitter(skip):
    return lambda batches: _split(skip, batches)


def _score(parameters: bytes, subjects: list[int], skip: frozenset, batches):
    p = _unpacked(parameters, len(subjects) + 1)
    known: dict[str, int] = {}
    table = np.zeros((0, len(p["b"])))
    for batch in batches:
        docs, counts, words = [], [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = sentences(text, skip)
            docs.append(doc)
            counts.append(len(found))
            words += found
        if len(known) > 500_000:
            known, table = {}, table[:0]
        fresh = list({w for s in words for w in s if w not in known})
        if fresh:
            known |= {w: len(known) + i for i, w in enumerate(fresh)}
            table = np.vstack([table, word_vectors(fresh, p["e"]) @ p["w"]])
        z = np.zeros((0, len(p["b"])))
        if words:
            length = np.array([len(s) for s in words])
            at = np.array([known[w] for s in words for w in s])
            z = np.add.reduceat(table[at], np.concatenate(([0], np.cumsum(length)[:-1])), axis=0) / length[:, None] + p["b"]
        treats = z[:, :-1] > np.log(THRESHOLD / (1 - THRESHOLD))
        quoted = z[:, -1] > 0
        treats &= ~quoted[:, None]
        owner = np.repeat(np.arange(len(docs)), counts)
        own = np.bincount(owner[~quoted], minlength=len(docs))
        per = np.stack([np.bincount(owner[treats[:, k]], minlength=len(docs)) for k in range(len(subjects))], axis=1) if subjects else np.zeros((len(docs), 0))
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(own, pa.int64()), pa.array(list(per.astype(np.int64)), pa.list_(pa.int64()))], names=["doc_id", "n_sentences", "counts"])


def _scorer(parameters, subjects, skip):
    return lambda batches: _score(parameters, subjects, skip, batches)


def document_subjects(documents: DataFrame, labels: DataFrame, areas: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """One row per document (doc_id, n_sentences, subjects array<struct<subject_id, n_sentences, share>>): the subjects
    treated by at least ``share`` of the document's own sentences.

    Null, empty and placeholder texts have no sentences and no subjects.  Labels for unknown documents or subjects are
    ignored, repeated ones count once; without any label no document gets a subject.  A document delivered several times
    gives a row per delivery.  Whole texts are read; extra columns are ignored."""
    subjects = [int(r["subject_id"]) for r in areas.where("subject_id is not null").select("subject_id").distinct().orderBy("subject_id").collect()]  # a fixed table
    instructions = [line_key(r["instruction"]) for r in items.where("instruction is not null").select("instruction").distinct().collect()]  # one line per benchmark
    skip = frozenset(r["line"] for r in boilerplate(documents).collect()) | frozenset(instructions)  # at most 1,000 lines
    parameters = train(documents, labels, items, subjects, skip)
    counted = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scorer(parameters, subjects, skip), "doc_id long, n_sentences long, counts array<long>")
    ids = F.array(*[F.lit(s).cast("long") for s in subjects])
    n = F.greatest(F.col("n_sentences"), F.lit(1))
    each = F.zip_with(ids, "counts", lambda s, c: F.struct(s.alias("subject_id"), c.alias("n_sentences"), (c / n).alias("share")))
    return counted.select("doc_id", "n_sentences", F.filter(each, lambda x: (x["n_sentences"] > 0) & (x["share"] >= share)).alias("subjects"))


def _subjects_of(spark: SparkSession, root: str) -> DataFrame:
    return document_subjects(*[spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "doc_labels", "subject_areas", "eval_items")])


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    """Subjects of each document."""
    return _subjects_of(spark, root).select("doc_id", F.explode("subjects").alias("s")).select("doc_id", "s.subject_id").distinct()


def p9_composition(spark: SparkSession, root: str) -> DataFrame:
    """The corpus by subject: documents, sentences, and their shares."""
    scored, _ = materialise(_subjects_of(spark, root), "subjects")
    total = scored.agg(F.count("*").alias("all_documents"), F.sum("n_sentences").alias("all_sentences"))
    per = scored.select(F.explode("subjects").alias("s")).groupBy("s.subject_id").agg(F.count("*").alias("n_documents"), F.sum("s.n_sentences").alias("n_sentences"))
    one = total.first()  # one row
    return per.withColumn("document_share", F.col("n_documents") / F.lit(max(1, one["all_documents"]))).withColumn("sentence_share", F.col("n_sentences") / F.lit(max(1, one["all_sentences"] or 0)))


QUERIES = {"p9_found": p9_found, "p9_composition": p9_composition}
ORACLES: dict[str, str] = {}
