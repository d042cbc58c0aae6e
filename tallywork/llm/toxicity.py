"""Toxicity of whole texts: a lexicon, misspellings of its terms, and the words around them.

The lexicon is learnt from labelled documents. Its trie is intersected with Levenshtein automata,
one walk over all terms at a time; the walk's states are kept, so after a while a word costs a
table lookup per character and most words end within a few. A term counts less where the words
around it quote it or report it."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.llm.common import text_of, without
from tallywork.llm.labelled import fold, sample, weights

#: Bounds of the sample that the lexicon is learnt from.
TOXIC_DOCS, CLEAN_DOCS = 3000, 9000
THRESHOLD = 0.3
FLOOR = 0.005
#: Chance that any word at all gets into the lexicon by accident.
SIGNIFICANCE = 0.05
#: Letters of a word's beginning that can be a term for all its endings.
STEM = 5
#: Words around a term that are looked at.
REACH = 6
#: What is left of a term's weight.
QUOTED, ALOOF = 0.04, 0.9
REMEMBERED_WORDS, REMEMBERED_STATES = 300_000, 200_000
RESULT = ("held_out", "score", "predicted")

# Marks and words that report speech, words that address someone, look-alike signs.
OPENING = "\"'“„«‘‹`"
CLOSING = "\"'”“»’›`"
REPORTING = frozenset(
    "said says saying wrote writes quote quotes quoted quoting cited reported word words term terms called insult insults slur slurs "
    "sagte schrieb zitat zitierte wort begriff genannt beleidigung dit écrit cite citation mot mots terme insulte "
    "dijo escribió cita palabra palabras término insulto".split()
)
ADDRESSING = frozenset("you your you're u ur du dein deine dich ihr tu toi ton ta vous votre tú te eres usted ustedes".split())
LOOK_ALIKE = str.maketrans("0134578@$!|", "oieastbasil")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG_RUN = re.compile(r"(.)\1{2,}")


def bare(word: str) -> str:
    """Without marks at its ends."""
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b]


def stem(word: str) -> str:
    """The entry that stands for all words with this beginning."""
    return word[:STEM] + "*"


def allowed(term: str) -> int:
    """Edits that a misspelling of the term may have."""
    return 0 if len(term) < 5 or term.endswith("*") else 1 if len(term) < 10 else 2


class FuzzyTrie:
    """The terms' trie walked together with one Levenshtein automaton per term.

    A state is the set of (trie node, edits so far) that a prefix can stand for. States and steps
    are made when first needed and kept; state 0 is dead."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.most = [-1]
        for term in terms:
            edits, node = allowed(term), 0
            self.most[0] = max(self.most[0], edits)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.most.append(-1)
                node = self.children[node][letter]
                self.most[node] = max(self.most[node], edits)
            self.term[node] = term
        self.clear()

    def clear(self) -> None:
        self.number: dict[frozenset, int] = {frozenset(): 0}
        self.sets: list[frozenset] = [frozenset()]
        self.steps: list[dict[str, int]] = [{}]
        self.accepts: list[tuple[int, str] | None] = [None]
        self.start = self.state({0: 0})

    def state(self, reached: dict[int, int]) -> int:
        """The state of these nodes and of those reached by leaving out letters of the term."""
        todo = list(reached.items())
        while todo:
            node, edits = todo.pop()
            if reached.get(node) != edits:
                continue
            for child in self.children[node].values():
                if edits < self.most[child] and edits + 1 < reached.get(child, 99):
                    reached[child] = edits + 1
                    todo.append((child, edits + 1))
        key = frozenset(reached.items())
        if key not in self.number:
            ends = [(e, self.term[n]) for n, e in key if self.term[n] is not None and e <= allowed(self.term[n])]
            self.number[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            self.accepts.append(min(ends) if ends else None)
        return self.number[key]

    def step(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.most[node] and edits < reached.get(node, 99):
                reached[node] = edits

        for node, edits in self.sets[state]:
            reach(node, edits + 1)  # a letter too many
            for other, child in self.children[node].items():
                reach(child, edits + (other != letter))
        found = self.state(reached) if reached else 0
        self.steps[state][letter] = found
        return found

    def nearest(self, word: str) -> tuple[int, str] | None:
        """(edits, term) of the nearest term, ties to the first in order; None if all are too far."""
        if len(self.sets) > REMEMBERED_STATES:
            self.clear()
        state, steps = self.start, self.steps
        for letter in word:
            state = steps[state][letter] if letter in steps[state] else self.step(state, letter)
            if not state:
                return None
        return self.accepts[state]


@dataclass
class Model:
    """Probability that a document with the term (or a misspelling of it) is toxic; words that
    are close to a term and yet ordinary."""

    #: Evidence, number of words -> log odds: intercept, weight of the evidence, weight of log length.
    scale: tuple[float, float, float] = (0.0, 0.0, 0.0)
    exact: dict[str, float] = field(default_factory=dict)
    misspelt: dict[str, float] = field(default_factory=dict)
    ordinary: frozenset[str] = frozenset()


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.trie = FuzzyTrie(sorted(model.exact))
        self.harmless: set[str] = set()

    def hit(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of a word as it stands in the text, in lower case."""
        plain = bare(word)
        if plain in self.model.exact:
            return plain, 0
        if len(plain) > STEM and stem(plain) in self.model.exact:
            return stem(plain), 0
        if not plain or plain in self.model.ordinary:
            return None
        found = self.trie.nearest(plain)
        if found is None:
            other = LONG_RUN.sub(r"\1", word.translate(LOOK_ALIKE))
            other = bare(other)
            if other != plain and other not in self.model.ordinary:
                found = self.trie.nearest(other)
                found = found and (max(found[0], 1), found[1])
        return (found[1], found[0]) if found else None

    def score(self, text: str) -> float:
        evidence, words = self.evidence(text)
        if not evidence:
            return FLOOR
        a, b, c = self.model.scale
        return max(FLOOR, 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * evidence + c * math.log1p(words))))))

    def evidence(self, text: str) -> tuple[float, int]:
        """What the terms of the text say together, each distinct word once, and the number of words."""
        low = text.lower()
        new = set(low.split()).difference(self.harmless)
        hits = {}
        for word in new:
            if found := self.hit(word):
                hits[word] = found
            else:
                self.harmless.add(word)
        if len(self.harmless) > REMEMBERED_WORDS:
            self.harmless = set()
        if not hits:
            return 0.0, 0
        words = low.split()
        best: dict[str, float] = {}
        for i, word in enumerate(words):
            if word in hits:
                term, edits = hits[word]
                weight = self.model.exact[term] if not edits else self.model.misspelt.get(term, 0.5)
                best[word] = max(best.get(word, 0.0), -math.log1p(-min(0.999, weight)) * around(words, i))
        return sum(best.values()), len(words)


def around(words: list[str], i: int) -> float:
    """How much of a term's weight counts: little in a quotation or where speech is reported in the
    same sentence, all where someone is addressed.

    A quotation holds the term only if it is still open there and is closed later."""
    before, after = words[max(0, i - REACH) : i], words[i + 1 : i + 1 + REACH]
    is_open = False
    for word in before:
        is_open = (is_open or word[0] in OPENING) and not closes(word)
    quoted = (is_open or words[i][0] in OPENING) and any(map(closes, [words[i], *after]))
    reported = False
    for word in reversed(before):
        if ends_sentence(word):
            break
        reported = reported or bare(word) in REPORTING
    if quoted or reported:
        return QUOTED
    return 1.0 if any(bare(w) in ADDRESSING for w in before + after) else ALOOF


def closes(word: str) -> bool:
    return word.rstrip(".,;:!?)")[-1:] in tuple(CLOSING)


def ends_sentence(word: str) -> bool:
    return word.rstrip(CLOSING + ")")[-1:] in (".", "!", "?")


def learn(texts: DataFrame, stands_for: dict[int, float] | None = None) -> Model:
    """From (text, label), a bounded sample; a text of label y stands for ``stands_for[y]`` texts.

    A term is a word, or the beginning of words, that occurs between different neighbours in toxic texts (so copies of one
    passage count once), so much more often than in clean ones that chance is ruled out for the
    whole vocabulary; counts and share of toxic texts are both the sample's there. Scores follow the
    share of toxic texts among all labels. How far misspellings can be trusted follows from how often clean texts have
    ordinary words that look like them."""
    counted = "word string, spot long, label int, text_hash long"

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label, hashed in zip(*[c.to_pylist() for c in batch.columns]):
                found = [bare(w) for w in WORDS.findall(text.lower())]
                if label:
                    rows = {(w, hash_of(b, a)) for b, w, a in zip([""] + found, found, found[1:] + [""]) if w}
                else:
                    rows = {(w, hashed) for w in found if w}
                rows |= {(stem(w), spot) for w, spot in rows if len(w) > STEM}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([label] * len(rows), pa.int32()), pa.array([hashed] * len(rows), pa.int64())],
                    names=["word", "spot", "label", "text_hash"],
                )

    counts = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.countDistinct("text").alias("n")).collect()}
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    if not n_toxic or not n_clean:
        return Model()
    spots = texts.select("text", "label", F.xxhash64("text").alias("h")).mapInArrow(words, counted)
    toxic = F.col("label") == 1
    stats = spots.groupBy("word").agg(
        F.countDistinct(F.when(toxic, F.col("spot"))).alias("t"), F.countDistinct(F.when(~toxic, F.col("text_hash"))).alias("c"),
        F.countDistinct(F.when(toxic, F.col("text_hash"))).alias("d"),
    )
    vocabulary = spots.agg(F.approx_count_distinct("word").alias("v")).first()["v"]
    share = n_toxic / (n_toxic + n_clean)
    chance = F.col("d") * math.log(share) + F.when(F.col("c") > 0, F.col("c") * F.log((F.col("d") + F.col("c")) * math.e / F.col("c"))).otherwise(0.0)
    terms = stats.filter((F.least("t", "d") >= 2) & (F.col("t") * 2 >= F.col("d"))).filter(chance + math.log(max(vocabulary, 1)) < math.log(SIGNIFICANCE)).collect()
    rate = {r["word"]: ((r["d"] + 0.5) / n_toxic, (r["c"] + 0.25) / n_clean) for r in terms}
    model = Model(exact={w: a / (a + b) for w, (a, b) in rate.items()})

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for text, label, hashed in zip(*[c.to_pylist() for c in batch.columns]):
                rows = []
                for word in {bare(w) for w in text.lower().split()}:
                    found = scorer.hit(word)
                    if found and found[1]:
                        rows.append((word, found[0]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                     pa.array([label] * len(rows), pa.int32()), pa.array([hashed] * len(rows), pa.int64())],
                    names=["word", "term", "label", "text_hash"],
                )

    near = texts.select("text", "label", F.xxhash64("text").alias("h")).mapInArrow(alike, "word string, term string, label int, text_hash long")
    seen = near.groupBy("word", "term").agg(
        F.countDistinct(F.when(toxic, F.col("text_hash"))).alias("d"), F.countDistinct(F.when(~toxic, F.col("text_hash"))).alias("c")
    ).collect()
    ordinary = frozenset(r["word"] for r in seen if r["c"] * n_toxic > r["d"] * n_clean)  # more usual in clean texts
    once, odd, entries = {}, {}, {}
    for term in model.exact:
        entries[term[:STEM]] = entries.get(term[:STEM], 0) + 1
    for r in seen:
        family = r["term"][:STEM]
        if r["c"] == 1:  # as many words again are still unseen
            once[family] = once.get(family, 0) + 1
        if not r["c"]:
            odd[family] = odd.get(family, 0) + r["d"]
    for term in model.exact:
        family = term[:STEM]
        unseen = once.get(family, 0) / n_clean
        more = max(0.0, odd.get(family, 0) / n_toxic - unseen)  # ordinary words are new in toxic texts as well
        a, b = more + 0.5 / n_toxic, unseen + 0.25 * entries[family] / n_clean
        model.misspelt[term] = 0.9 * a / (a + b)
    model.ordinary = ordinary

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found = [scorer.evidence(x.as_py()) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int64()), batch.column(1)],
                names=["evidence", "words", "label"],
            )

    points = texts.select("text", "label").mapInArrow(gather, "evidence double, words long, label int").filter("evidence > 0").collect()
    model.scale = scaled([(r["evidence"], r["words"], r["label"], (stands_for or {}).get(r["label"], 1.0)) for r in points])
    return model


def scaled(points: list[tuple[float, int, int, float]]) -> tuple[float, float, float]:
    """Logistic regression of the label on evidence and log length, over the texts with evidence:
    (evidence, words, label, weight of the row). Newton's method with a small penalty that pulls
    towards one term of full weight being enough."""
    import numpy as np

    prior, strength = np.array([-1.0, 1.0, 0.0]), np.array([0.5, 5.0, 5.0])
    if not points:
        return tuple(prior)
    x = np.array([[1.0, e, math.log1p(n)] for e, n, _, _ in points])
    y, w = np.array([p[2] for p in points], float), np.array([p[3] for p in points])
    beta = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (w * (p - y)) + strength * (beta - prior)
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + np.diag(strength), gradient)
        beta -= np.clip(step, -1, 1)
    return tuple(float(b) for b in beta)


def hash_of(before: str, after: str) -> int:
    """A hash that is the same in every worker."""
    import zlib

    return zlib.crc32(before.encode("utf-8", "replace")) << 32 >> 1 ^ zlib.crc32(after.encode("utf-8", "replace"))


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs``, whole texts."""
    source = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found = [scorer.score(str(x)) for x in batch.column(1)]
            predicted = [int(s >= THRESHOLD) for s in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64()), pa.array(predicted, pa.int32())], names=schema.names)

    return source.mapInArrow(score, schema)


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on labelled rows whose fold of four is not 2, at most TOXIC_DOCS and CLEAN_DOCS."""
    keep, most = fold("doc_id", 4) != 2, {1: TOXIC_DOCS, 0: CLEAN_DOCS}
    return learn(sample(docs, labels, "toxic", keep, most), weights(labels, "toxic", keep, most))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per document: doc_id, held_out, score, predicted.

    Only texts are inputs of a score. Null and empty texts get the floor score; without usable
    labels every text does. Rows that repeat come back as often; ids may be null. Other columns
    are not read; an empty table gives no rows."""
    return scored(docs, trained(docs, labels)).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted to be toxic."""
    model = trained(docs, labels)
    fields = without(docs, "__score").schema
    names = fields.names

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        at = names.index("text")
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(x.as_py() or "") < THRESHOLD for x in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(keep, fields)
